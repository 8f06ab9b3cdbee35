"""Ticker vetting: company list x reference records -> one verdict per row.

Order of checks per input row (first that applies wins):
blank symbol -> repeated symbol -> format -> reference lookup outcome ->
active -> instrument type -> company-name match.

The lookup side is a reference *table* (one record per symbol and as-of
date), joined instead of called.  Duplicates are found with a partial
``min(position)`` aggregate joined back on (symbol, position), so a symbol
listed a million times is still spread over many tasks.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barsmith.functions.names import names_match
from barsmith.functions.symbols import normalise_symbol, symbol_format_ok
from barsmith.operators.asof import as_of as last_known

# Verdict texts.
EMPTY_SYMBOL = "Empty symbol"
DUPLICATE_SYMBOL = "Duplicate symbol: {symbol}"
INVALID_FORMAT = "Invalid format '{symbol}' — expected 1-5 uppercase letters"
NOT_FOUND = "Ticker not found on Polygon — may be delisted or renamed"
PERMISSION = "Could not verify (API permission issue)"
HTTP_OTHER = "API returned {status}"
UNREACHABLE = "API unreachable: no reference record"
NO_DATA = "No reference data returned by Polygon"
INACTIVE = "Ticker is inactive/delisted (was: '{name}')"
NOT_A_STOCK = "'{name}' is not a stock (Polygon type: '{type}')"
NAME_MISMATCH = ("Company name mismatch — expected '{expected}' but Polygon returned '{actual}'. "
                 "This ticker may have been reused by a different company.")
COMMON_STOCK = "CS"

VETTING_COLUMNS = ("position", "symbol", "outcome", "reason", "warning", "matched_name")


def _fmt(template: str, **cols: Column) -> Column:
    """Fill ``{name}`` slots of a fixed text with column values."""
    parts: list[Column] = []
    rest = template
    while "{" in rest:
        head, tail = rest.split("{", 1)
        key, rest = tail.split("}", 1)
        parts += [F.lit(head), F.coalesce(cols[key].cast("string"), F.lit(""))]
    parts.append(F.lit(rest))
    return F.concat(*parts)


def reference_as_of(reference: DataFrame, as_of: str | None = None) -> DataFrame:
    """Latest reference record per symbol with ``as_of`` on or before the
    given date (all records when ``as_of`` is None)."""
    ref = reference.withColumn("symbol", normalise_symbol(F.col("symbol")))
    if as_of is not None:
        ref = ref.where(F.col("as_of").isNull() | (F.col("as_of") <= F.lit(as_of).cast("date")))
    w = Window.partitionBy("symbol").orderBy(F.col("as_of").desc_nulls_last(), F.col("http_status").asc_nulls_last(),
                                             F.col("name").asc_nulls_last())
    return ref.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def first_listings(companies: DataFrame) -> DataFrame:
    """(symbol, position, is_first, last_name) for the first listing of every
    non-blank normalised symbol; a repeated symbol is compared under the name
    that it was listed with last."""
    return (companies.where(F.col("symbol") != "")
            .groupBy("symbol").agg(F.min("position").alias("position"),
                                   F.max_by("expected_name", "position").alias("last_name"))
            .withColumn("is_first", F.lit(True)))


def vet_tickers(companies: DataFrame, reference: DataFrame, as_of: str | None = None, listed_on: str | None = None) -> DataFrame:
    """One verdict per company-list row (``position, company_name, symbol``).

    The reference record of a symbol is the latest on or before ``as_of``, or,
    if ``listed_on`` names a date column of ``companies``, on or before the date
    of that very listing (a listing without a date finds no record).

    ``outcome`` is ``valid``, ``invalid`` or ``duplicate`` (a repeat of an
    earlier row; only warned about, neither valid nor invalid)."""
    rows = companies.select(
        "position", F.col("company_name").alias("expected_name"),
        F.coalesce(normalise_symbol(F.col("symbol")), F.lit("")).alias("symbol"),
        *([F.col(listed_on).cast("date").alias("listed_on")] if listed_on else []),
    )
    rows = (rows.join(first_listings(rows), ["symbol", "position"], "left")
            .withColumn("expected_name", F.coalesce("last_name", "expected_name")).drop("last_name"))
    # only what can be looked up goes to the lookup: one row a symbol, so no
    # blank or repeated symbol is a hot key of the join
    looked_up = F.coalesce(F.col("is_first"), F.lit(False)) & symbol_format_ok(F.col("symbol"))
    record = ["http_status", "active", "type", F.col("name").alias("actual_name"), F.lit(True).alias("_has_record")]
    if listed_on:
        known = reference.select(normalise_symbol(F.col("symbol")).alias("symbol"), "as_of", *record)
        found = last_known(rows.where(looked_up), known, "symbol", "listed_on", "as_of",
                           prefer=[F.col("http_status").asc_nulls_last(), F.col("actual_name").asc_nulls_last()]).drop("as_of")
    else:
        found = rows.where(looked_up).join(reference_as_of(reference, as_of).select("symbol", *record), "symbol", "left")
    joined = found.unionByName(rows.where(~looked_up), allowMissingColumns=True)

    sym = F.col("symbol")
    status = F.col("http_status")
    name = F.col("actual_name")
    record_empty = F.col("active").isNull() & F.col("type").isNull() & name.isNull()
    ok_http = status < 400
    expected_given = F.coalesce(F.col("expected_name"), F.lit("")) != ""
    actual_given = F.coalesce(name, F.lit("")) != ""

    # (outcome, reason, warning) per branch, in precedence order
    branches: list[tuple[Column, str, Column | None, Column | None]] = [
        (sym == "", "invalid", F.lit(EMPTY_SYMBOL), None),
        (F.col("is_first").isNull(), "duplicate", None, _fmt(DUPLICATE_SYMBOL, symbol=sym)),
        (~symbol_format_ok(sym), "invalid", _fmt(INVALID_FORMAT, symbol=sym), None),
        (F.col("_has_record").isNull() | status.isNull(), "valid", None, F.lit(UNREACHABLE)),
        (status == 404, "invalid", F.lit(NOT_FOUND), None),
        (status == 403, "valid", None, F.lit(PERMISSION)),
        (~ok_http, "valid", None, _fmt(HTTP_OTHER, status=status)),
        (record_empty, "invalid", F.lit(NO_DATA), None),
        (~F.coalesce(F.col("active"), F.lit(True)), "invalid", _fmt(INACTIVE, name=name), None),
        ((F.coalesce(F.col("type"), F.lit("")) != "") & (F.upper(F.col("type")) != COMMON_STOCK),
         "invalid", _fmt(NOT_A_STOCK, name=name, type=F.col("type")), None),
        (expected_given & actual_given & ~names_match(F.col("expected_name"), name, sym),
         "invalid", _fmt(NAME_MISMATCH, expected=F.col("expected_name"), actual=name), None),
    ]

    def chain(pick) -> Column:
        expr = None
        for cond, outcome, reason, warning in branches:
            val = pick(outcome, reason, warning)
            expr = F.when(cond, val) if expr is None else expr.when(cond, val)
        return expr

    outcome = chain(lambda o, r, w: F.lit(o)).otherwise(F.lit("valid"))
    reason = chain(lambda o, r, w: r if r is not None else F.lit(None).cast("string")).otherwise(F.lit(None))
    warning = chain(lambda o, r, w: w if w is not None else F.lit(None).cast("string")).otherwise(F.lit(None))
    passed = outcome == "valid"
    return joined.select(
        "position", "symbol",
        outcome.alias("outcome"), reason.alias("reason"), warning.alias("warning"),
        F.when(passed & warning.isNull(), name).alias("matched_name"),
    ).orderBy("position")  # verdicts in input order


def duplicates(companies: DataFrame) -> DataFrame:
    """Normalised symbols listed more than once: (symbol, n, first_position)."""
    rows = companies.select("position", F.coalesce(normalise_symbol(F.col("symbol")), F.lit("")).alias("symbol"))
    return (rows.where(F.col("symbol") != "").groupBy("symbol")
            .agg(F.count(F.lit(1)).alias("n"), F.min("position").alias("first_position"))
            .where(F.col("n") > 1))


def report(vetting: DataFrame) -> DataFrame:
    """One row of counts: total (valid + invalid), valid, invalid, warnings."""
    o = F.col("outcome")
    return vetting.agg(
        F.count_if(o.isin("valid", "invalid")).alias("total"),
        F.count_if(o == "valid").alias("valid"),
        F.count_if(o == "invalid").alias("invalid"),
        F.count_if(F.col("warning").isNotNull()).alias("warnings"),
    )


def findings(vetting: DataFrame) -> DataFrame:
    """(kind, position, symbol, text): each warning and each invalid symbol with
    its reason, as the report lists them; a row may have both."""
    kinds = [("warning", F.col("warning")), ("invalid", F.when(F.col("outcome") == "invalid", F.col("reason")))]
    said = F.filter(F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("text")) for k, c in kinds]), lambda x: x["text"].isNotNull())
    return vetting.select("position", "symbol", F.explode(said).alias("_f")).select("_f.kind", "position", "symbol", "_f.text")


def valid_symbols(vetting: DataFrame) -> DataFrame:
    return vetting.where(F.col("outcome") == "valid").select("symbol").distinct()
