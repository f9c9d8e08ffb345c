"""SimHash near-dedup with the generalised pigeonhole principle.

Fingerprints at ``MAX_BITS`` or fewer differing bits are linked. The 64 bits are grouped into m partitions of
correlated bits; the partitions get thresholds t_1..t_m (-1: not used) that add up to MAX_BITS - m + 1, so two
linked fingerprints differ in at most t_i bits in some partition i. A dynamic program picks the thresholds, and
the number of partitions, with the fewest estimated probes and candidates. Each fingerprint probes the
partition values within the threshold; pairs that meet are verified by their differing bits inside the join.

Only distinct fingerprints take part, so copies of a text cost nothing. A partition value with more than
``HOT_BUCKET`` fingerprints is split by the pigeonhole principle on its remaining bits, which loses no pair.

Defined results: a text without words (null, empty) has fingerprint 0 and is linked like any other; rows with
null ids take part, and the component id is the smallest id that is not null (null if there is none).
Repeated rows and extra columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .text import carried, checked_broadcast, join_docs, restored, saved, table

SHINGLE, MAX_BITS, BITS = 3, 3, 64
HOT_BUCKET = 4096              # distinct fingerprints under one partition value before it is split
MAX_BROADCAST_ROWS = 500_000   # rows of one or two numbers sent to every executor at most
CHUNK = 1 << 16                # shingles counted at a time


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the text: the bits set in over half of its shingles' XXH64 (signed 64-bit)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    if len(words) < shingle:
        start, end = [0], [len(joined)]
    else:
        start = [0, *(ends[:len(words) - shingle] + 1).tolist()]
        end = ends[shingle - 1:].tolist()
    digest, votes = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(start), CHUNK):
        h = np.array([digest(joined[s:e], 42) for s, e in zip(start[at:at + CHUNK], end[at:at + CHUNK], strict=True)], np.uint64)
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(start), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) for every row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
            yield pa.record_batch([batch.column("doc_id"), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def bit_statistics(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """(n, 64 x 64 matrix): in how many fingerprints both bits are set, over all of them. Each task adds up
    its own matrix; 64 rows come back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            raw = np.ascontiguousarray(batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64))
            for at in range(0, len(raw), CHUNK):
                bits = np.unpackbits(raw[at:at + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                total += bits.T @ bits
        yield pa.record_batch([pa.array(np.arange(BITS), pa.int32()), pa.array(total.astype(np.int64).tolist(), pa.list_(pa.int64()))],
                              names=["bit", "both"])

    parts = distinct.select("fp").mapInArrow(run, "bit int, both array<long>")
    rows = parts.groupBy("bit").agg(*[F.sum(F.get("both", F.lit(k))).alias(f"c{k}") for k in range(BITS)]).collect()
    matrix = np.zeros((BITS, BITS))
    for row in rows:
        matrix[row["bit"]] = row[1:]
    return distinct.count(), matrix


def correlated_partitions(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """The bits in m groups of nearly equal size, each grown around the bit left that varies least by the
    bits most correlated with the group."""
    p = np.diag(both) / max(n, 1)
    var = np.maximum(p * (1 - p), 1e-9)
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.sqrt(np.outer(var, var))
    left, groups = set(range(BITS)), []
    for g in range(m):
        size = len(left) // (m - g)
        group = [min(left, key=lambda b: (var[b], b))]
        left.discard(group[0])
        while len(group) < size:
            best = max(left, key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            left.discard(best)
        groups.append(sorted(group))
    return groups


def estimated_cost(n: int, both: np.ndarray, group: list[int], t: int) -> float:
    """Probes plus candidates of a partition at threshold t, with the bits taken as independent."""
    if t < 0:
        return 0.0
    p = np.diag(both)[group] / max(n, 1)
    within = np.zeros(t + 1)
    within[0] = 1.0
    for differ in 2 * p * (1 - p):
        within[1:] = within[1:] * (1 - differ) + within[:-1] * differ
        within[0] *= 1 - differ
    return n * sum(comb(len(group), d) for d in range(t + 1)) + n * n / 2 * within.sum()


def allocate(n: int, both: np.ndarray, groups: list[list[int]], max_bits: int) -> tuple[float, list[int]]:
    """(cost, thresholds): the cheapest thresholds that add up to max_bits - m + 1."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}       # by the sum of (t + 1) so far
    for group in groups:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, ts) in best.items():
            for t in range(-1, max_bits - used + 1):
                at, total = used + t + 1, cost + estimated_cost(n, both, group, t)
                if at <= max_bits + 1 and (at not in step or total < step[at][0]):
                    step[at] = (total, [*ts, t])
        best = step
    return best[max_bits + 1]


def plan(n: int, both: np.ndarray, max_bits: int = MAX_BITS) -> tuple[list[list[int]], list[int]]:
    """Partitions and thresholds of least estimated cost, over 1 to max_bits + 1 partitions of 2 or more."""
    options = []
    for m in range(2, max_bits + 2):
        groups = correlated_partitions(n, both, m)
        options.append((*allocate(n, both, groups, max_bits), groups))
    _, thresholds, groups = min(options, key=lambda o: o[0])
    return groups, thresholds


def _bits(fp: Column, group: list[int]) -> Column:
    """The bits of a group as a number."""
    return reduce(lambda a, b: a.bitwiseOR(b), [
        F.shiftleft(F.shiftrightunsigned(fp, b).bitwiseAND(F.lit(1).cast("long")), i) for i, b in enumerate(group)])


def links(distinct: DataFrame, max_bits: int = MAX_BITS, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """(a, b), a > b: the distinct fingerprints (column ``fp``) at most ``max_bits`` bits apart."""
    n, both = bit_statistics(distinct)
    if n < 2:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).filter("false")
    groups, thresholds = plan(n, both, max_bits)
    used = [(i, g, t) for i, (g, t) in enumerate(zip(groups, thresholds, strict=True)) if t >= 0]
    values = F.array(*[F.struct(F.lit(i).alias("part"), _bits(F.col("fp"), g).alias("value")) for i, g, _ in used])
    index = distinct.select("fp", F.explode(values).alias("k")).select("fp", "k.part", "k.value")
    balls = F.array(*[F.struct(F.lit(i).alias("part"), _bits(F.col("fp"), g).bitwiseXOR(F.lit(mask).cast("long")).alias("value"))
                      for i, g, t in used for d in range(t + 1)
                      for mask in (sum(1 << b for b in bits) for bits in combinations(range(len(g)), d))])
    probes = distinct.select("fp", F.explode(balls).alias("k")).select("fp", "k.part", "k.value")
    hot = saved(index.groupBy("part", "value").agg(F.count("*").alias("n")).filter(F.col("n") > hot_bucket).drop("n"))
    hot = checked_broadcast(hot, MAX_BROADCAST_ROWS).withColumn("hot", F.lit(True))

    def keyed(rows: DataFrame) -> DataFrame:
        """One key, or for a hot value one for each quarter of the other bits: linked fingerprints agree on one."""
        whole = F.array(F.xxhash64("part", "value"))
        split = F.lit(None).cast("array<bigint>")
        for i, g, _ in used:
            rest = [b for b in range(BITS) if b not in set(g)]
            quarters = [rest[q::max_bits + 1] for q in range(max_bits + 1)]
            split = F.when(F.col("part") == i, F.array(*[
                F.xxhash64("part", "value", F.lit(q), _bits(F.col("fp"), bits)) for q, bits in enumerate(quarters)])).otherwise(split)
        return rows.join(hot, ["part", "value"], "left").select("fp", F.explode(F.when(F.col("hot"), split).otherwise(whole)).alias("key"))

    left, right = keyed(probes).alias("l"), keyed(index).alias("r")
    apart = F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp")))
    return (left.join(right, (F.col("l.key") == F.col("r.key")) & (F.col("l.fp") > F.col("r.fp")) & (apart <= max_bits))
            .select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b")).distinct())


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``."""
    fps = saved(fingerprints(docs, shingle))
    distinct = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(distinct, max_bits))
    member = saved(distinct.join(roots, distinct["fp"] == roots["node"], "left")
                   .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    least = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = member.join(least, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` for each component: the smallest (doc_id, text hash), null ids last; of rows equal
    in both one stays."""
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("text_hash"))
    found = near_duplicates(docs.select(place.alias("doc_id"), "text"), shingle, max_bits)
    keep = saved(found.filter(F.col("doc_id") == F.col("component_id")).groupBy("component_id").agg(F.count("*").alias("n")))
    keys = keep.select("component_id.doc_id", "component_id.text_hash")
    own = carried(docs, "doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    stay = join_docs(own, checked_broadcast(keys, MAX_BROADCAST_ROWS), "left_semi")
    if not keep.filter("n > 1").isEmpty():
        stay = stay.dropDuplicates(["doc_id", "text_hash"])
    return restored(stay, docs.columns, ["doc_id", "text"], [])


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
