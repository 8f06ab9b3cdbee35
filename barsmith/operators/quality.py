"""Data-quality gate: RAW bars -> VALID + QUARANTINE, lossless.

Each rule is a boolean column that is never NULL: a missing value fails it, so every input row lands in exactly one output and the reason is
the first rule, in list order, that failed.  The flag is computed once;
``valid`` and ``quarantine`` are two filters over the same flagged frame.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.functions.dates import parse_iso_date
from barsmith.schemas import QUARANTINE, VALID_BARS

# Fixed value: a price must be strictly above one cent.
MIN_PRICE = 0.01
REASON = "failure_reason"


# The rules' names, in the order in which they are tried.
RULE_NAMES = (
    "non_null_symbol", "non_null_date", "non_null_close", "positive_close", "non_null_open", "positive_open",
    "high_gte_low", "high_gte_close", "low_lte_close", "non_negative_volume", "date_is_valid_type",
)


def rules(min_price: float = MIN_PRICE, finite_prices: bool = False) -> list[tuple[str, Column]]:
    """Ordered (name, predicate) list; ``date`` is already parsed.  Each
    predicate is TRUE or FALSE: a comparison with a missing value is FALSE.

    ``date_is_valid_type`` can never be the first failure (``non_null_date``
    comes earlier); it stays for rule-list parity."""
    def given(name: str) -> Column:
        return F.col(name).isNotNull()

    def priced(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(min_price)) > min_price

    def covers(upper: str, lower: str) -> Column:
        return given(upper) & given(lower) & ~(F.col(lower) > F.col(upper))

    tests = {
        "non_null_symbol": F.length(F.trim(F.coalesce(F.col("symbol"), F.lit("")))) > 0,
        "non_null_date": given("date"),
        "date_is_valid_type": F.col("date").cast("date").isNotNull(),
        "non_negative_volume": F.coalesce(F.col("volume"), F.lit(0)) >= 0,
        "high_gte_low": covers("high", "low"),
        "high_gte_close": covers("high", "close"),
        "low_lte_close": covers("close", "low"),
    }
    for price in ("close", "open"):
        tests |= {f"non_null_{price}": given(price), f"positive_{price}": priced(price)}
    out = [(name, tests[name]) for name in RULE_NAMES]
    if finite_prices:
        # NaN sorts above every number in Spark, so NaN > 0.01 is TRUE
        numbers = [F.isnan(F.coalesce(F.col(p), F.lit(0.0))) for p in ("open", "high", "low", "close")]
        out.append(("finite_prices", ~reduce(lambda a, b: a | b, numbers)))
    return out


def first_failure(rule_list: list[tuple[str, Column]]) -> Column:
    return F.coalesce(*[F.when(~rule, F.lit(name)) for name, rule in rule_list])


def flag(raw: DataFrame, rule_list: list[tuple[str, Column]] | None = None) -> DataFrame:
    """RAW (date as text) -> RAW with parsed ``date``, ``date_raw`` and
    ``failure_reason`` (NULL = valid)."""
    typed = raw.withColumn("date_raw", F.col("date")).withColumn("date", parse_iso_date(F.col("date")))
    return typed.withColumn(REASON, first_failure(rule_list or rules()))


def valid(flagged: DataFrame) -> DataFrame:
    """Rows that passed every rule, in the VALIDATED schema order."""
    return flagged.where(F.col(REASON).isNull()).select(*[F.col(f.name) for f in VALID_BARS.fields])


def quarantine(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col(REASON).isNotNull()).select(*[F.col(f.name) for f in QUARANTINE.fields])


def reason_counts(flagged: DataFrame) -> DataFrame:
    """(failure_reason, n) for quarantined rows."""
    return flagged.where(F.col(REASON).isNotNull()).groupBy(REASON).agg(F.count(F.lit(1)).alias("n"))


def metrics(flagged: DataFrame) -> DataFrame:
    """One row: total_input, total_valid, total_quarantine, pass_rate (1.0 when
    empty) -- a single aggregate pass."""
    ok = F.col(REASON).isNull()
    counts = flagged.agg(
        F.count(F.lit(1)).alias("total_input"),
        F.count_if(ok).alias("total_valid"),
        F.count_if(~ok).alias("total_quarantine"),
    )
    return counts.withColumn(
        "pass_rate",
        F.when(F.col("total_input") == 0, F.lit(1.0)).otherwise(F.col("total_valid") / F.col("total_input")),
    )


def outcome_counts(flagged: DataFrame) -> DataFrame:
    """(failure_reason, n) for every outcome, valid rows under NULL: one small
    aggregate from which both :func:`reason_counts` and :func:`metrics` follow."""
    return flagged.groupBy(REASON).agg(F.count(F.lit(1)).alias("n"))


def metrics_from_counts(counts: DataFrame) -> DataFrame:
    """:func:`metrics` computed from :func:`outcome_counts` output."""
    ok = F.col(REASON).isNull()
    zero = F.lit(0).cast("long")
    totals = counts.agg(
        F.coalesce(F.sum("n"), zero).alias("total_input"),
        F.coalesce(F.sum(F.when(ok, F.col("n"))), zero).alias("total_valid"),
        F.coalesce(F.sum(F.when(~ok, F.col("n"))), zero).alias("total_quarantine"),
    )
    return totals.withColumn(
        "pass_rate",
        F.when(F.col("total_input") == 0, F.lit(1.0)).otherwise(F.col("total_valid") / F.col("total_input")),
    )

