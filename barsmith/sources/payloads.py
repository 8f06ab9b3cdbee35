"""Landed daily-bar response envelopes -> RAW bars.

A landed envelope is one JSON document per line:
``{"ticker", "status", "error", "resultsCount", "results": [{t,o,h,l,c,v,vw,n}]}``.
Only ``OK`` and ``DELAYED`` envelopes contribute rows; an error envelope, an
envelope without results and a line that is not JSON contribute none and
never fail the scan (PERMISSIVE parsing).  Files are read in parallel by
Spark; nothing is fetched or held by the driver.

A line may also be a landing record, ``{"requested": symbol, "body": text}``:
the body as it came for a request, so that one that is no envelope can still be
put down to its symbol.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from barsmith.functions.dates import epoch_ms_to_iso_date
from barsmith.functions.symbols import normalise_symbol
from barsmith.schemas import PAYLOAD, RAW_BARS

# Fixed value: envelope statuses that carry usable bars.
USABLE_STATUSES = ("OK", "DELAYED")


CORRUPT = "_corrupt"
#: how a landing record starts, as JSON writers put it
RECORD_START = '{"requested"'
#: characters of an unreadable body that a reason quotes
QUOTED = 60


def read_payload_files(spark: SparkSession, path: str) -> DataFrame:
    """Envelope columns from JSON-lines files, with the fixed schema, and the
    columns of :func:`parse_payload_lines` beside them."""
    return parse_payload_lines(spark.read.text(path))


def parse_payload_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Envelope columns from a text column (e.g. ``spark.read.text``), the symbol
    asked for (``requested``: the record's, else the envelope's ticker), and the
    body itself where it could not be read (``corrupt``)."""
    line = F.col(column)
    is_record = F.ltrim(line).startswith(RECORD_START)
    record = F.from_json(F.when(is_record, line), "requested string, body string", {"mode": "PERMISSIVE"})
    out = lines.select(line.alias("_line"), record.alias("_record")).select(
        F.coalesce(F.col("_record.body"), F.col("_line")).alias("_body"), F.col("_record.requested").alias("requested"))
    schema = StructType([*PAYLOAD.fields, StructField(CORRUPT, StringType())])
    env = F.from_json(F.col("_body"), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    out = out.select("requested", env.alias("_env")).select("requested", "_env.*")
    symbol = F.coalesce(F.nullif(normalise_symbol(F.col("requested")), F.lit("")), normalise_symbol(F.col("ticker")))
    return out.select(*PAYLOAD.names, symbol.alias("requested"), F.col(CORRUPT).alias("corrupt"))


def _zero_if_missing(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def bars_from_payloads(envelopes: DataFrame, ingested_at: str | Column | None = None) -> DataFrame:
    """Flatten usable envelopes to RAW bars.

    Coercions of the vendor contract: a missing price or volume becomes 0 (and
    then fails the quality rules); a missing or zero ``vw``/``n`` becomes
    NULL; volume and transactions truncate to whole numbers; a missing ``t``
    is the epoch day."""
    stamp = (F.current_timestamp() if ingested_at is None
             else ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at).cast("timestamp"))
    bars = (envelopes.where(F.col("status").isin(*USABLE_STATUSES))
            .select(normalise_symbol(F.col("ticker")).alias("symbol"),
                    # a null element of ``results`` is not a bar
                    F.explode(F.filter("results", lambda x: x.isNotNull())).alias("b")))
    b = F.col
    return bars.select(
        "symbol",
        epoch_ms_to_iso_date(b("b.t")).alias("date"),
        _zero_if_missing(b("b.o")).alias("open"),
        _zero_if_missing(b("b.h")).alias("high"),
        _zero_if_missing(b("b.l")).alias("low"),
        _zero_if_missing(b("b.c")).alias("close"),
        _zero_if_missing(b("b.v")).cast("long").alias("volume"),
        F.nullif(b("b.vw"), F.lit(0.0)).alias("vwap"),
        F.when(F.coalesce(b("b.n"), F.lit(0.0)) == 0, F.lit(None)).otherwise(b("b.n")).cast("long").alias("transactions"),
        stamp.alias("ingested_at"),
    ).select(*[F.col(f.name) for f in RAW_BARS.fields])


def corrupt_responses(responses: DataFrame) -> DataFrame:
    """(symbol, body) of the bodies that could not be read, as they came: the
    sink of what no schema holds.  The symbol is NULL if the line names none."""
    return responses.where(F.col("corrupt").isNotNull()).select(F.col("requested").alias("symbol"), F.col("corrupt").alias("body"))


def response_reason() -> Column:
    """Why a response has no bars, NULL if it has some; the first character
    puts what a server said before what is missing."""
    has_bars = F.col("status").isin(*USABLE_STATUSES) & F.exists("results", lambda x: x.isNotNull())
    said = F.concat(F.lit("1status "), F.coalesce("status", F.lit("missing")), F.when(F.coalesce("error", F.lit("")) != "", F.concat(F.lit(": "), "error")).otherwise(F.lit("")))
    return (F.when(F.col("corrupt").isNotNull(), F.concat(F.lit("2not an envelope: "), F.left("corrupt", F.lit(QUOTED))))
            .when(~F.coalesce(F.col("status").isin(*USABLE_STATUSES), F.lit(False)), said)
            .when(~F.coalesce(has_bars, F.lit(False)), F.lit("3no results")))


NEVER_LANDED = "never landed"


def fetch_failures(requested: DataFrame, responses: DataFrame) -> DataFrame:
    """(symbol, n_responses, reason) of each requested symbol for which no bar
    arrived: what a server said, else that a body was no envelope, else that
    there were no results; NEVER_LANDED if no response came at all.  Of several
    reasons of a kind the least text counts.  ``responses`` are
    :func:`parse_payload_lines` rows."""
    wanted = requested.select(normalise_symbol(F.col("symbol")).alias("symbol")).where(F.col("symbol") != "").distinct()
    # partial aggregates: a symbol with many responses collapses map-side
    answers = (responses.select(F.col("requested").alias("symbol"), response_reason().alias("why")).where(F.col("symbol").isNotNull())
               .groupBy("symbol").agg(F.count(F.lit(1)).alias("n_responses"), F.max(F.col("why").isNull()).alias("arrived"), F.min("why").alias("why")))
    return (wanted.join(answers, "symbol", "left").where(~F.coalesce("arrived", F.lit(False)))
            .select("symbol", F.coalesce("n_responses", F.lit(0)).cast("long").alias("n_responses"),
                    F.coalesce(F.substr("why", F.lit(2)), F.lit(NEVER_LANDED)).alias("reason")))


def bars_per_symbol(raw: DataFrame) -> DataFrame:
    """(symbol, n_bars): landed bar count per symbol."""
    return raw.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_bars"))
