"""Fuzzy company-name comparison as Spark column expressions.

A name is reduced to its set of meaningful words: lower-case, punctuation to
spaces, legal-form words removed, words of three or more characters kept.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal-form / filler words stripped before comparing names.
LEGAL_FORM_WORDS = (
    "inc", "incorporated", "corp", "corporation", "co", "company", "ltd", "limited",
    "plc", "llc", "group", "holdings", "international", r"class\s+[a-c]", "the",
)

# (?U): Unicode whitespace and word boundaries, like Python's default ``re``.
_LEGAL_FORM_RE = r"(?iU)\b(" + "|".join(LEGAL_FORM_WORDS) + r")\b"
_NOT_WORD_RE = r"(?U)[^a-z0-9\s]"
MIN_WORD_LENGTH = 3


def name_words(name: Column) -> Column:
    """Distinct meaningful words of a company name (empty array for NULL)."""
    cleaned = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), _NOT_WORD_RE, " "),
                               _LEGAL_FORM_RE, " ")
    words = F.split(F.trim(cleaned), r"(?U)\s+")
    return F.array_distinct(F.filter(words, lambda w: F.length(w) >= MIN_WORD_LENGTH))


def symbol_word_in(text: Column, symbol: Column) -> Column:
    """TRUE when ``symbol`` appears as a whole word of ``text`` (any case)."""
    # quote the symbol literally; a "\E" inside it is split out as Pattern.quote does
    quoted = F.replace(symbol, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    pattern = F.concat(F.lit(r"(?iuU)\b\Q"), quoted, F.lit(r"\E\b"))
    return F.coalesce(F.regexp_like(text, pattern), F.lit(False))


def names_match(expected: Column, actual: Column, symbol: Column) -> Column:
    """Same company?  Expected without substance -> TRUE; actual without
    substance -> FALSE; any shared word -> TRUE; symbol as a whole word of the
    actual name -> TRUE (rebrands such as a ticker-named successor)."""
    exp_words = name_words(expected)
    act_words = name_words(actual)
    by_symbol = F.when(F.coalesce(symbol, F.lit("")) != "", symbol_word_in(actual, symbol)).otherwise(F.lit(False))
    return (
        F.when(F.size(exp_words) == 0, F.lit(True))
        .when(F.size(act_words) == 0, F.lit(False))
        .when(F.arrays_overlap(exp_words, act_words), F.lit(True))
        .otherwise(by_symbol)
    )
