"""How filters that follow each other interact: what each removes, what an
earlier one had removed already, and which labelled rows are lost.

Relations.  The rows get a number, and each filter a table of the numbers of
the rows that fail it, with their part and their labels.  A filter's table with
the prefix '' is what it removes when it comes first.

Joins.  What a filter removes after a prefix of others depends on the set of
those only, so sets stand for prefixes.  The filters are gone through in one
order.  For each, every relation (filter f, prefix P) is joined with its table:
the left-anti join is what f still removes after P and it, the left-semi join
what it makes redundant for f.  Ten joins by row number give all sets of five
filters; relations shrink as prefixes grow, and no text or list of rows takes
part.  Counts by part, filter and prefix, at most filters * 2 ** (filters - 1)
rows a part, are then read out for every order: survivors are the part's rows
without all that the steps so far removed.

Defined results: a null text is an empty one, a null part an empty string;
repeated rows are counted each, a null id fails no filter that compares ids and
has no label; of repeated labels any that says 1 holds, a null label says
nothing; an empty table gives an empty one; only the named columns are read, so
others cannot clash.
"""
from __future__ import annotations

from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barsmith.llm.common import forget, written

SPACE = r"[\x20\x09-\x0D]+"
LABELS = ("good", "toxic")


def numbered(docs: DataFrame, labels: DataFrame, fails: dict[str, Column], copies: str | None, doc_id: str, text: str, part: str) -> DataFrame:
    """(row, part, good, toxic, fails): the rows with the names of the filters
    they fail as an array; ``copies`` names the filter of repeated texts.  Written."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
                       F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"))
    rows = rows.withColumn("words", F.expr(f"filter(split(text, r'{SPACE}'), w -> w <> '')"))
    own = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in fails.items()])) if fails else F.expr("CAST(array() AS array<string>)")
    rows = rows.select("id", "part", own.alias("fails"), F.sha2("text", 256).alias("digest"))
    # the numbers hold because the rows are written with them
    first = rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "audited")
    if copies:
        # of equal texts all but those of the least id fail; most texts have one row and join nothing.
        # Written, as Spark splits a hot digest only if it deals out both sides for the join
        least = rows.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
        least = written(least.select("digest", "least"), "least")
        rows = rows.join(least, "digest", "left").withColumn("fails", F.when(F.col("id") > F.col("least"), F.concat("fails", F.array(F.lit(copies)))).otherwise(F.col("fails")))
    said = labels.groupBy(F.col("doc_id").alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    out = rows.join(said, "id", "left").select("row", "part", *[F.coalesce(c, F.lit(0)).alias(c) for c in LABELS], "fails")
    out = written(out, "rows")
    forget(first, *([least] if copies else []))
    return out


def counted(relation: DataFrame, *by: str) -> DataFrame:
    return relation.groupBy(*by).agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))


def relations(failing: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """{filter: (row, part, good, toxic)} -> counts (part, filter, prefix, n,
    good, toxic) of what a filter removes after the prefix, and (part, filter,
    prefix, redundant) of what a prefix takes from it that the prefix without its
    last filter left; prefixes are sets, written in the order of ``failing``."""
    left = reduce(DataFrame.unionByName, [t.withColumn("filter", F.lit(f)).withColumn("prefix", F.lit("")) for f, t in failing.items()])
    taken = []
    for i, (g, table) in enumerate(failing.items()):
        ids = table.select("row")
        others = left.where(F.col("filter") != g)
        after = F.concat("prefix", F.lit(g))
        hit = others.join(ids, "row", "left_semi").withColumn("prefix", after)
        taken.append(written(counted(hit, "part", "filter", "prefix").select("part", "filter", "prefix", F.col("n").alias("redundant")), "redundant"))
        more = written(left.unionByName(others.join(ids, "row", "left_anti").withColumn("prefix", after)), "left")
        if i:
            forget(left)
        left = more
    removed = written(counted(left, "part", "filter", "prefix"), "removed")
    forget(left)
    return removed, reduce(DataFrame.unionByName, taken)


def audited(rows: DataFrame, filters: str) -> DataFrame:
    """(row, part, good, toxic, fails), whose row numbers hold, -> a row for each
    part, order of the filters and step."""
    failing = {f: written(rows.where(F.array_contains("fails", f)).drop("fails"), f"failing-{f}") for f in filters}
    removed, taken = relations(failing)
    forget(*failing.values())
    totals = rows.groupBy("part").agg(F.count("*").alias("total"))
    orders = ",".join(sorted(map("".join, permutations(filters))))
    steps = (totals.select("part", "total", F.explode(F.split(F.lit(orders), ",")).alias("filter_order"))
             .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))).alias("step"))
             .withColumn("filter", F.expr("substr(filter_order, step, 1)"))
             .withColumn("before", F.expr("substr(filter_order, 1, step - 1)")))
    # the set of the filters before, in the order that the relations name it
    steps = steps.withColumn("prefix", F.concat(*[F.when(F.col("before").contains(f), F.lit(f)).otherwise(F.lit("")) for f in filters]))
    # what a prefix makes redundant adds up over its filters, each after those before it
    chain = F.transform(F.sequence(F.lit(1), F.length("prefix")), lambda i: F.substr(F.col("prefix"), F.lit(1), i))
    sets = steps.select("part", "filter", "prefix").distinct()
    redundant = (sets.where("prefix <> ''").select("part", "filter", "prefix", F.explode(chain).alias("upto"))
                 .join(taken.withColumnRenamed("prefix", "upto"), ["part", "filter", "upto"])
                 .groupBy("part", "filter", "prefix").agg(F.sum("redundant").alias("redundant")))
    alone = removed.where(F.length("prefix") == len(filters) - 1).select("part", "filter", F.col("n").alias("unique_fails"))
    out = (steps.join(removed, ["part", "filter", "prefix"], "left").join(redundant, ["part", "filter", "prefix"], "left")
           .join(alone, ["part", "filter"], "left"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    out = out.select("part", "filter_order", "step", "filter", "total", zero("n").alias("removed"), zero("redundant").alias("redundant"),
                     zero("unique_fails").alias("unique_fails"), zero("good").alias("good_lost"), zero("toxic").alias("toxic_lost"))
    sofar = Window.partitionBy("part", "filter_order").orderBy("step")
    # a filter stands in each order once
    every = Window.partitionBy("part", "filter")
    return (out.withColumn("kept", F.col("total") - F.sum("removed").over(sofar)).withColumn("shapley", F.sum("removed").over(every))
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))


def shapley_share(audit: DataFrame, filters: str) -> DataFrame:
    """(part, filter, share): the mean number of rows that a filter removes, over
    all orders."""
    name = F.expr("substr(filter_order, step, 1)").alias("filter")
    return audit.select("part", name, (F.col("shapley") / factorial(len(filters))).alias("share")).distinct()


def rules() -> dict[str, Column]:
    """Failure conditions over a text and its words."""
    words, distinct = F.size("words").cast("long"), F.size(F.array_distinct("words")).cast("long")
    points = F.length("text").cast("long")
    capitals = points - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {"A": words < 50, "B": 100 * distinct < 65 * words, "C": 100 * capitals > 5 * points, "D": F.col("text").rlike("[#$%&*|]")}


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """The audit of the rules A to D and of E, which a text fails that a smaller
    id has too."""
    return audited(numbered(docs, labels, rules(), "E", doc_id, text, part), "ABCDE")


def q_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return audit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


SQL_FILTER_AUDIT = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part,
    [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS words FROM documents
),
failed AS (
  SELECT d.part, coalesce(l.quality, 0) = 1 AS good, coalesce(l.toxic, 0) = 1 AS toxic, {
    'A': len(words) < 50, 'B': 100 * len(list_distinct(words)) < 65 * len(words),
    'C': 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text),
    'D': regexp_matches(text, '[#$%&*|]'), 'E': coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)} AS f
  FROM docs d LEFT JOIN labels l USING (doc_id)
),
bits AS (SELECT part, good, toxic, [f['A'], f['B'], f['C'], f['D'], f['E']] AS f FROM failed),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
classes AS (SELECT part, good, toxic, f, count(*) AS n FROM bits GROUP BY ALL),
steps AS (
  SELECT part, filter_order, step, n, good, toxic,
    [f[ascii(x) - 64] FOR x IN string_split(filter_order, '')] AS o
  FROM classes, orders, range(1, 6) AS r(step)
),
said AS (
  SELECT *, o[step] AS fails, list_bool_or(o[1:step - 1]) AS gone, list_bool_or(o[1:step]) AS over,
    len([x FOR x IN o IF x]) = 1 AS lone FROM steps
),
counted AS (
  SELECT part, filter_order, step::INTEGER AS step,
    coalesce(sum(n) FILTER (NOT over), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (fails AND NOT coalesce(gone, false)), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (fails AND coalesce(gone, false)), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails AND lone), 0)::BIGINT AS unique_fails,
    coalesce(sum(n) FILTER (fails AND good AND NOT coalesce(gone, false)), 0)::BIGINT AS good_lost,
    coalesce(sum(n) FILTER (fails AND toxic AND NOT coalesce(gone, false)), 0)::BIGINT AS toxic_lost
  FROM said GROUP BY ALL
)
SELECT *, (sum(removed) OVER (PARTITION BY part, filter_order[step]))::BIGINT AS shapley FROM counted
"""
