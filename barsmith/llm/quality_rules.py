"""Weak supervision of text quality with DataFrame expressions only.

Rules look at one measure each and vote good, vote bad or abstain.  Which
rules agree is counted over all rows as votes patterns (at most 3 ** rules
groups, whatever the input), and expectation-maximisation over these counts
estimates how often each rule is right on good and on bad text.  A text's
posterior of being good then follows from its votes.  Texts below hard limits
(``base_failed``) are rejected whatever the posterior.

Defined results: a null text is an empty one; a text without words has only
zeros and fails the base rules; repeated rows are scored alike and separately;
an empty table gives an empty table and the prior accuracies; all columns of
the input are kept, whatever their names.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.llm.common import fresh, written

SPACE = r"[\x20\x09-\x0D]+"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURES = [*BASE, "n_lines", "n_upper", "n_plain_words"]
#: words in a window whose repetition counts
WINDOW = 5
#: before any vote is seen: the share of good texts; how often a rule votes bad,
#: votes good and abstains on bad (0) and on good texts (1); and the weight of
#: these beliefs as a share of all texts
PRIOR_GOOD, PRIOR_WEIGHT = 0.85, 0.02
PRIOR_VOTES = ((0.4, 0.1, 0.5), (0.02, 0.48, 0.5))
ROUNDS = 100
KEEP_FROM = 0.5


def measured(df: DataFrame, text: str = "text", name: str = "measures") -> DataFrame:
    """``df`` with a struct of the measures; a text is cut into words once."""
    t, w, li, g, r = (fresh(df, c) for c in ("t", "w", "li", "g", "r"))
    out = df.withColumn(t, F.coalesce(F.col(text), F.lit("")))
    out = out.withColumns({
        w: F.expr(rf"filter(split(`{t}`, r'{SPACE}'), x -> x <> '')"),
        li: F.expr(rf"filter(split(`{t}`, '\n'), x -> x rlike r'[^\x20\x09-\x0D]')"),
    })
    # windows are compared by hash first; equal windows have equal hashes, so
    # a text without equal hashes has no repetition
    five = ", ".join(f"`{w}`[i + {k}]" for k in range(WINDOW))
    out = out.withColumn(g, F.expr(
        f"IF(size(`{w}`) >= {WINDOW}, transform(sequence(0, size(`{w}`) - {WINDOW}), i -> xxhash64({five})), CAST(array() AS array<bigint>))"))
    # the words themselves decide: sort the windows of such a text and keep
    # the places of those that equal a neighbour
    out = out.withColumn(r, F.expr(f"""
        IF(size(array_distinct(`{g}`)) < size(`{g}`),
           sort_array(transform(sequence(0, size(`{g}`) - 1), i -> named_struct('words', array_join(slice(`{w}`, i + 1, {WINDOW}), ' '), 'at', i))),
           CAST(array() AS array<struct<words: string, at: int>>))"""))
    out = out.withColumn(r, F.expr(f"""
        sort_array(transform(filter(`{r}`, (x, i) -> x.words = get(`{r}`, i - 1).words OR x.words = get(`{r}`, i + 1).words), x -> x.at))"""))
    covered = F.expr(f"""
        aggregate(transform(`{r}`, (p, i) -> least({WINDOW}, coalesce(get(`{r}`, i + 1), p + {WINDOW}) - p)), 0L, (s, n) -> s + n)""")
    long = {
        "n_words": F.size(w), "word_chars": F.length(F.array_join(w, "")),
        "n_symbols": F.size(F.split(t, "[#*$%&|<>]")) - 1,
        "n_dup_lines": F.size(li) - F.size(F.array_distinct(li)), "n_repeat_words": covered,
        "n_lines": F.size(li), "n_upper": F.size(F.split(t, r"\p{Lu}")) - 1,
        # words of letters with at most one mark at the end
        "n_plain_words": F.expr(rf"size(filter(`{w}`, x -> x rlike r'^[\p{{L}}\p{{M}}]+[.,;:!?]?$'))"),
    }
    return out.withColumn(name, F.struct(*[v.cast("long").alias(k) for k, v in long.items()])).drop(t, w, li, g, r)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def votes(m: Column) -> dict[str, Column]:
    """1 good, 0 bad, null abstains."""

    def rule(value: Column, bad: Column, good: Column | None = None) -> Column:
        out = F.when(value.isNull(), None).when(bad, 0)
        return out if good is None else out.when(good, 1)

    words, chars = F.nullif(m["n_words"], F.lit(0)), F.nullif(m["word_chars"], F.lit(0))
    plain, symbols, repeats = m["n_plain_words"] / words, m["n_symbols"] / words, m["n_repeat_words"] / words
    dup, mean, upper = m["n_dup_lines"] / F.nullif(m["n_lines"], F.lit(0)), chars / words, m["n_upper"] / chars
    return {  # that a fault is absent says little, so most rules abstain then
        "length": rule(m["n_words"], m["n_words"] < 15, m["n_words"] >= 40),
        "plain": rule(plain, plain < 0.75, plain > 0.9),
        "symbols": rule(symbols, symbols > 0.2),
        "dup_lines": rule(dup, dup > 0.3),
        "repeats": rule(repeats, repeats > 0.2),
        "word_length": rule(mean, ~mean.between(2.5, 12)),
        "upper": rule(upper, upper > 0.4),
    }


def estimate(patterns: list[tuple[list[int | None], int]], rules: int) -> dict:
    """EM over (votes, count) patterns.

    Returns the share of good texts and, for every rule, how often it votes
    bad, votes good and abstains on bad and on good texts; both with a
    Dirichlet prior, so a rule that never speaks keeps its prior accuracy.
    """
    total = sum(n for _, n in patterns)
    good, weight = PRIOR_GOOD, PRIOR_WEIGHT * total
    speaks = [[[*PRIOR_VOTES[y]] for y in (0, 1)] for _ in range(rules)]
    for _ in range(ROUNDS if total else 0):
        posts = [posterior(v, good, speaks) for v, _ in patterns]
        good = (sum(p * n for p, (_, n) in zip(posts, patterns)) + PRIOR_GOOD * weight) / (total + weight)
        for j in range(rules):
            for y in (0, 1):
                seen = [weight * p for p in PRIOR_VOTES[y]]
                for p, (v, n) in zip(posts, patterns):
                    seen[2 if v[j] is None else v[j]] += n * (p if y else 1 - p)
                speaks[j][y] = [x / sum(seen) for x in seen]
    return {"good": good, "speaks": speaks}


def posterior(v: list[int | None], good: float, speaks: list) -> float:
    x = math.log(good / (1 - good))
    for vote, by in zip(v, speaks):
        k = 2 if vote is None else vote
        x += math.log(by[1][k] / by[0][k])
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


def scored(df: DataFrame, measures: str, name: str = "quality") -> DataFrame:
    """``df``, which has a struct of measures, with a struct ``name`` instead:
    the measures, base_failed, posterior, kept.  The rows are written once;
    counting the patterns and scoring read them."""
    v = fresh(df, "votes")
    rows = written(df.withColumn(v, F.struct(*[c.alias(k) for k, c in votes(F.col(measures)).items()])), "quality")
    names = rows.schema[v].dataType.names
    counts = rows.groupBy(v).count().collect()  # at most 3 ** rules rows
    fitted = estimate(sorted((([*r[0]], r[1]) for r in counts), key=str), len(names))
    logit = F.lit(math.log(fitted["good"] / (1 - fitted["good"])))
    for k, by in zip(names, fitted["speaks"]):
        bad, good, none = (math.log(by[1][i] / by[0][i]) for i in range(3))
        logit = logit + F.when(F.col(v)[k] == 0, bad).when(F.col(v)[k] == 1, good).otherwise(none)
    m, p = F.col(measures), 1 / (1 + F.exp(-logit))
    return rows.withColumn(name, F.struct(
        *[m[k].alias(k) for k in MEASURES], base_failed(m).alias("base_failed"), p.alias("posterior"),
        (~base_failed(m) & (p >= KEEP_FROM)).alias("kept"))).drop(measures, v)


def keep_good(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows of good texts, with the columns of ``df``."""
    m, name = fresh(df, "measures"), fresh(df, "quality")
    return scored(measured(df, text, m), m, name).where(F.col(name)["kept"]).select(*[F.col(f"`{c}`") for c in df.columns])


def q_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    # only the key goes on to the written table, the text stays behind
    rows = scored(measured(docs.select("doc_id", "text")).select("doc_id", "measures"), "measures")
    return rows.select("doc_id", *[F.col("quality")[k].alias(k) for k in (*BASE, "base_failed", "kept", "posterior")])
