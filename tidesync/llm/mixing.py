"""Mixing sources to target weights by weighted fair queueing.

Each source's documents come in a shuffled order (by a seeded hash of the id), one pass after the
other. A document's virtual finish time is the source's cumulative tokens divided by the source's
target; documents of all sources are then served by finish time until the total budget is used. All
sums are taken in two levels (hash bucket or time slice, then inside it), so a source with a third of
all rows is spread over many tasks.

Defined results: null text has size 0; a document of size 0 is never taken (it adds no word); a null
source is a source of its own, ordered last; with no words at all every target and every ``taken``
is 0. Repeated rows are separate documents, equal in order and therefore interchangeable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .text import carried, join_docs, plain_words, restored, saved, table

SLICES = 1 << 12          # time slices of the finish-time histogram
ROWS_A_BUCKET = 20_000    # rows of one source and hash bucket, about


def ranked(keys: DataFrame, column: str) -> DataFrame:
    """``keys`` with ``position`` (from 0) by ``column``, nulls last: range-sorted, counted per
    partition, so no task sorts all keys."""
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = saved(keys.repartitionByRange(parts, F.col(column).asc_nulls_last())
                    .withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)      # one row a partition
    offsets = ordered.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy(F.col(column).asc_nulls_last())
    return (ordered.join(offsets, "part")
            .withColumn("position", F.col("offset") + F.row_number().over(inside) - 1).drop("part", "offset"))


def source_targets(sizes: DataFrame, weights: Sequence[float], max_epochs: int) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Sources in order get the weights in turn and share the total of all sizes; a target stops at
    ``max_epochs`` times its source's size and the excess is shared again by weight until none is above.
    Each round stops at least one more source, and its free total and weight are two numbers.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    shares = ranked(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "source") \
        .withColumn("weight", F.get(cycle, F.col("position") % len(weights)))
    shares = saved(shares.withColumn("cap", F.col("source_size").cast("double") * max_epochs))
    level, free_before = 0.0, -1
    total = shares.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    while True:
        # capped at this level: they keep their cap, the others share what is left
        is_free = F.col("cap") > F.col("weight") * level if level else F.lit(True)
        row = shares.agg(F.sum(F.when(~is_free, F.col("cap"))).alias("kept"),
                         F.sum(F.when(is_free, F.col("weight"))).alias("weight"),
                         F.count(F.when(is_free, True)).alias("n")).first()
        if not row["n"] or row["n"] == free_before:
            break
        free_before = row["n"]
        level = (total - (row["kept"] or 0.0)) / row["weight"]
    return shares.select("source", "source_size",
                         F.least(F.col("weight") * level, F.col("cap")).alias("target"))


def _within_budget(served: DataFrame, budget: float) -> DataFrame:
    """The first rows by finish time whose running size stays within the budget. Slices of finish time
    are summed first (their number is fixed); only the slice that crosses the budget is ordered."""
    order = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)       # at most 2 * SLICES + 1 rows
    sums = saved(served.groupBy("slice").agg(F.sum("size").alias("slice_size"))
                 .withColumn("through_slice", F.sum("slice_size").over(order)))
    crossing = sums.filter(F.col("through_slice") > budget).agg(F.min("slice")).first()[0]
    if crossing is None:
        return served
    before = sums.filter(F.col("slice") < crossing).agg(F.coalesce(F.max("through_slice"), F.lit(0))).first()[0]
    inside = Window.partitionBy("slice").orderBy("finish", "source_key", "shuffle_key", "pass", "text_hash", "place") \
        .rowsBetween(Window.unboundedPreceding, 0)
    last = (served.filter(F.col("slice") == crossing).withColumn("running", before + F.sum("size").over(inside))
            .filter(F.col("running") <= budget).drop("running"))
    return served.filter(F.col("slice") < crossing).unionByName(last)


def mix(docs: DataFrame, weights: Sequence[float], max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """(doc_id, text_hash, source, size, source_size, target, taken) for every document."""
    measured = saved(docs.select(
        "doc_id", "source", F.size(plain_words(F.col("text"))).cast("long").alias("size"),
        F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"))).alias("shuffle_key"),
        F.xxhash64("text").alias("text_hash"),
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("source_key")))
    n_rows = measured.count()
    digits = 1                                     # hex digits of the hash that name a bucket
    while 16 ** digits * ROWS_A_BUCKET < n_rows:
        digits += 1
    targets = saved(source_targets(measured, weights, max_epochs))
    budget = targets.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    keyed = targets.select(F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("source_key"),
                           "source_size", "target")
    bucketed = measured.withColumn("bucket", F.substring("shuffle_key", 1, digits))
    sums = bucketed.groupBy("source_key", "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source_key", "bucket", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source_key", "bucket").orderBy("shuffle_key", "text_hash", "size")
    placed = saved(bucketed.withColumn("place", F.row_number().over(inside))
                   .withColumn("in_bucket", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
                   .join(offsets, ["source_key", "bucket"]).join(keyed, "source_key")
                   .withColumn("through", F.col("offset") + F.col("in_bucket")).drop("offset", "in_bucket"))
    # one row for each pass a document can be served in
    passes = F.ceil(F.try_divide(F.col("target"), F.col("source_size"))).cast("int")
    served = (placed.filter("size > 0 and target > 0")
              .withColumn("pass", F.explode(F.sequence(F.lit(0), F.least(passes, F.lit(max_epochs)) - 1)))
              .withColumn("finish", F.try_divide(F.col("pass") * F.col("source_size") + F.col("through"), F.col("target")))
              .select("source_key", "bucket", "place", "pass", "size", "finish", "shuffle_key", "text_hash")
              .withColumn("slice", F.floor(F.least(F.col("finish"), F.lit(2.0)) * SLICES)))
    taken = (_within_budget(saved(served), budget)
             .groupBy("source_key", "bucket", "place").agg(F.sum("size").alias("words")))
    return (placed.join(taken, ["source_key", "bucket", "place"], "left")
            .select("doc_id", "text_hash", "source", "size", "source_size", "target",
                    F.coalesce("words", F.lit(0)).alias("taken")))


def mix_documents(docs: DataFrame, weights: Sequence[float], max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """The documents the mix takes, with their columns, ``size``, ``target`` and ``taken``. Rows equal in
    id and text come back once, with the words taken of all of them."""
    plan = (mix(docs, weights, max_epochs, seed).filter("taken > 0").groupBy("doc_id", "text_hash")
            .agg(F.max("size").alias("mix_size"), F.max("target").alias("mix_target"), F.sum("taken").alias("mix_taken")))
    own = carried(docs, "doc_id", "text").withColumn("text_hash", F.xxhash64("text")).dropDuplicates(["doc_id", "text_hash"])
    done = join_docs(own, plan).withColumns({"size": F.col("mix_size"), "target": F.col("mix_target"), "taken": F.col("mix_taken")})
    return restored(done, docs.columns, ["doc_id", "text"], ["size", "target", "taken"])


# The contract's weights by source order, and the limit on repeats.
WEIGHTS, EPOCHS = (5, 2, 1), 3


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), WEIGHTS, EPOCHS).drop("text_hash", "source")


ORACLE = r"""
WITH d AS (SELECT doc_id, source,
        CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
        md5(concat('mix:', CAST(doc_id AS VARCHAR))) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS DOUBLE) AS w,
        3.0::DOUBLE * source_size AS cap FROM s),
c AS (SELECT *, coalesce(sum(cap) OVER q, 0) AS kept, (SELECT sum(w) FROM r) - coalesce(sum(w) OVER q, 0) AS free,
        (SELECT CAST(sum(source_size) AS DOUBLE) FROM r) AS total
        FROM r WINDOW q AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lv AS (SELECT min_by((total - kept) / free, cap / w) AS level FROM c WHERE cap / w >= (total - kept) / free),
t AS (SELECT source, source_size, least(w * level, cap) AS target FROM r, lv),
p AS (SELECT d.*, t.source_size, t.target,
        CAST(sum(size) OVER (PARTITION BY d.source ORDER BY k) AS BIGINT) AS through
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
f AS (SELECT doc_id, size, source, k, e, CAST(e * source_size + through AS DOUBLE) / target AS finish
        FROM p, range(3) g(e) WHERE size > 0 AND target > 0 AND e < ceil(target / source_size)),
o AS (SELECT doc_id, size, sum(size) OVER (ORDER BY finish, coalesce('=' || source, ''), k, e
        ROWS UNBOUNDED PRECEDING) AS running FROM f),
x AS (SELECT doc_id, CAST(sum(size) AS BIGINT) AS words FROM o
        WHERE running <= (SELECT sum(target) FROM t) GROUP BY doc_id)
SELECT p.doc_id, size, source_size, target, coalesce(words, 0) AS taken FROM p LEFT JOIN x ON p.doc_id = x.doc_id
"""
