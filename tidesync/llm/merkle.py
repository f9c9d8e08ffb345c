"""Merkle manifest of a dataset: a digest tree per language, a tree over the languages, and a proof per document.

Each row is a leaf. The leaves of a language ascend by id; while several nodes remain, every ``FANOUT`` consecutive
ones become one. The languages' last nodes, null first, go on to one root in the same way.

Trees are built in rounds of ``LEVELS`` levels by superblock, ``FANOUT ** LEVELS`` consecutive nodes: a round up leaves
one node a superblock, and a round down (``exchange``) cogroups each superblock's nodes with the one row of outer nodes
that its proofs need, reduces the superblock again, joins the proofs and, for the leaves, folds them, all in one
``applyInPandas``. A group never holds more than a superblock, whatever a language's share; positions come from a range
sort with one count a partition.

Defined results: nulls in any column are leaves like others; rows of an equal id (or null ids, which come first) are
ordered by their leaf digest, rows equal in every field are interchangeable; a null id is never tampered with. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .text import LOWER, UPPER, saved, small_broadcast, table

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
FANOUT = 8
LEVELS = 3                     # of one round: superblocks of 512 nodes
BLOCK = FANOUT ** LEVELS
MAX_BROADCAST_ROWS = 500_000   # (lang, first, n, tree) rows sent to every executor; beyond, the join shuffles
NODE = "tree long, pos long, n long, digest binary"
PATH = "tree long, pos long, at array<int>, others array<binary>, subroot binary, root binary"
PROOF = "doc_key string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


# ---------------------------------------------------------------- leaves and their positions

def leaf(**replaced: Column) -> Column:
    """Digest of a row's fields (32 bytes), some of them replaced."""
    def part(name: str) -> Column:
        value = replaced.get(name, F.col(name)).cast("string")
        return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))
    return F.unhex(F.sha2(F.concat(*[part(f) for f in FIELDS]), 256))


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with their number from 0 in ``order`` (which must tell rows apart): a range sort, a count per
    partition, and the sums of the counts before."""
    slots = saved(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("slot", F.monotonically_increasing_id()))     # partition << 33 | row in it
    part = F.shiftrightunsigned("slot", 33)
    counts = slots.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    firsts = counts.select(F.col("part"), F.coalesce(before, F.lit(0)).alias("before"))      # one row a partition
    return (slots.withColumn("part", part).join(F.broadcast(firsts), "part")
            .withColumn(name, F.col("before") + F.col("slot").bitwiseAND((1 << 33) - 1)).drop("part", "before", "slot"))


def placed_leaves(docs: DataFrame, tampered: Column) -> tuple[DataFrame, DataFrame]:
    """(leaves: tree, pos, n, digest, doc_key, changed; trees: lang, tree, first, n). ``tampered`` is the digest to
    fold in a leaf's place, null for the leaf's own."""
    leaves = saved(docs.select(F.col("doc_id"), F.col("lang"), leaf().alias("digest"), tampered.alias("changed"))
                   .withColumn("salt", F.monotonically_increasing_id()))
    ranked = numbered(leaves, ["lang", "doc_id", "digest", "salt"], "rank")
    langs = ranked.groupBy("lang").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n"))
    trees = saved(numbered(langs, ["first"], "tree"))
    of = small_broadcast(trees, MAX_BROADCAST_ROWS).withColumnRenamed("lang", "of_lang")
    placed = ranked.join(of, F.col("lang").eqNullSafe(F.col("of_lang")))
    return placed.select("tree", (F.col("rank") - F.col("first")).alias("pos"), "n", "digest",
                         F.col("doc_id").cast("string").alias("doc_key"), "changed"), trees


# ---------------------------------------------------------------- one superblock

def height(n: int) -> int:
    """Levels that a round reduces in a tree of ``n`` nodes."""
    levels = 0
    while n > 1 and levels < LEVELS:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def after_round(n: int) -> int:
    return -(-n // FANOUT ** height(n))


def joined(digests: list[bytes]) -> bytes:
    return sha256("".join(d.hex() for d in digests).encode()).digest()


def climb(digests: list[bytes], levels: int) -> list[list[bytes]]:
    """The nodes of each level, the given ones first."""
    tree = [digests]
    for _ in range(levels):
        tree.append([joined(tree[-1][i:i + FANOUT]) for i in range(0, len(tree[-1]), FANOUT)])
    return tree


def siblings(tree: list[list[bytes]], i: int) -> tuple[list[int], list[list[bytes]]]:
    """Per level below the top: node ``i``'s place in its run, and the run's other nodes."""
    at, others = [], []
    for level in tree[:-1]:
        run = level[i - i % FANOUT:i - i % FANOUT + FANOUT]
        at.append(i % FANOUT)
        others.append(run[:i % FANOUT] + run[i % FANOUT + 1:])
        i //= FANOUT
    return at, others


def fold(digest: bytes, at: list[int], others: list[list[bytes]]) -> bytes:
    for place, rest in zip(at, others, strict=True):
        digest = joined([*rest[:place], digest, *rest[place:]])
    return digest


def _pack(runs: list[list[bytes]]) -> list[bytes]:
    return [b"".join(r) for r in runs]


def _unpack(runs) -> list[list[bytes]]:
    return [[r[i:i + 32] for i in range(0, len(r), 32)] for r in runs]


# ---------------------------------------------------------------- rounds

def by_block() -> Column:
    return F.floor(F.col("pos") / F.lit(BLOCK)).cast("long").alias("block")


def up(nodes: DataFrame) -> DataFrame:
    """One round up: the node that each superblock becomes."""
    def run(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        n = int(block["n"].iloc[0])
        top = climb(list(block.sort_values("pos")["digest"]), height(n))[-1]
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "n": [after_round(n)], "digest": top})

    return saved(nodes.select("tree", "pos", "n", "digest").groupBy("tree", by_block()).applyInPandas(run, NODE))


def rounds_up(nodes: DataFrame, n: int) -> list[DataFrame]:
    """``nodes`` and what each round makes of them, until trees of at most ``n`` nodes have one left."""
    levels = [nodes]
    while True:
        levels.append(up(levels[-1]))
        n = after_round(n)
        if n <= 1:
            return levels


def exchange(nodes: DataFrame, outer: DataFrame, leaves: bool) -> DataFrame:
    """One round down: ``outer`` holds a superblock's path to the root; the result is the path of each node, or
    the proof and the folded root of each leaf."""
    def local(block: pd.DataFrame) -> list[list[bytes]]:
        return climb(list(block["digest"]), height(int(block["n"].iloc[0])))

    def paths(key: tuple, block: pd.DataFrame, path: pd.DataFrame) -> pd.DataFrame:
        block, above = block.sort_values("pos"), path.iloc[0]
        tree = local(block)
        rows = []
        for i, pos in enumerate(block["pos"]):
            at, others = siblings(tree, i)
            rows.append((key[0], pos, at + list(above["at"]), _pack(others) + list(above["others"]), above["subroot"], above["root"]))
        return pd.DataFrame(rows, columns=["tree", "pos", "at", "others", "subroot", "root"])

    def proofs(key: tuple, block: pd.DataFrame, path: pd.DataFrame) -> pd.DataFrame:
        block, above = block.sort_values("pos"), path.iloc[0]
        tree, outer_at, outer_others = local(block), list(above["at"]), _unpack(above["others"])
        tail = "".join(d.hex() for run in outer_others for d in run)
        ends: dict[bytes, str] = {}            # outer folds: one for all leaves that give the superblock's own node
        rows = []
        for i, (own, changed, doc_key) in enumerate(zip(block["digest"], block["changed"], block["doc_key"], strict=True)):
            at, others = siblings(tree, i)
            proof = sha256(("".join(d.hex() for run in others for d in run) + tail).encode()).hexdigest()
            node = fold(own if changed is None else changed, at, others)
            if node not in ends:
                ends[node] = fold(node, outer_at, outer_others).hex()
            rows.append((doc_key, own.hex(), above["subroot"].hex(), above["root"].hex(), proof, ends[node]))
        return pd.DataFrame(rows, columns=["doc_key", "leaf", "subroot", "root", "proof_sha256", "folded_root"])

    left = nodes.withColumn("block", by_block()).groupBy("tree", "block")
    right = outer.withColumnRenamed("pos", "block").groupBy("tree", "block")
    return left.cogroup(right).applyInPandas(proofs if leaves else paths, PROOF if leaves else PATH)


def down(levels: list[DataFrame], top: DataFrame, leaves: bool) -> DataFrame:
    """Paths of the first of ``levels`` (its proofs, if ``leaves``), from the paths of the last one's nodes."""
    paths = top
    for i in reversed(range(len(levels) - 1)):
        paths = exchange(levels[i], paths, leaves and i == 0)
        if i or not leaves:
            paths = saved(paths)
    return paths


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per row of ``docs``. ``tampered`` is the
    digest that a row's holder now computes, null where it is the manifest's leaf."""
    kind = docs.schema["doc_id"].dataType
    leaves, trees = placed_leaves(docs, F.lit(None).cast("binary") if tampered is None else tampered)
    size = trees.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("trees")).first()
    within = rounds_up(leaves, size["n"])
    subroots = within[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"),
                                 F.lit(size["trees"]).cast("long").alias("n"), "digest")
    over = rounds_up(subroots, size["trees"])
    none = lambda kind: F.array().cast(kind)
    top = over[-1].select("tree", "pos", none("array<int>").alias("at"), none("array<binary>").alias("others"),
                          F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root"))
    to_root = down(over, top, False)
    # the path of a language's last node starts where its tree ends
    own = within[-1].select(F.col("tree").alias("of_tree"), F.col("digest").alias("own"))
    starts = to_root.join(own, F.col("pos") == F.col("of_tree")).select(
        F.col("of_tree").alias("tree"), F.lit(0).cast("long").alias("pos"), "at", "others", F.col("own").alias("subroot"), "root")
    return down(within, starts, True).select(
        F.col("doc_key").cast(kind).alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


def tampering() -> Column:
    """The leaf of a row whose text lost its capitals, for a third of the ids; null for others."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return F.when(hit, leaf(text=F.translate("text", UPPER, LOWER)))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"), tampering())


# ---------------------------------------------------------------- oracle

def _oracle(levels: int = 12, forest_levels: int = 7) -> str:
    """The same trees by one SQL level a tree level; ``FANOUT ** levels`` rows a language are its bound."""
    def tree(name: str, base: str, key: str, count: int) -> str:
        ctes = [f"{name}0 AS ({base})"]
        for k in range(count):
            ctes.append(f"""{name}{k + 1} AS (SELECT {key}, pos // 8 AS pos, CASE WHEN max(n) > 1 THEN sha256(string_agg(d, '' ORDER BY pos)) ELSE max(d) END AS d,
  (max(n) + 7) // 8 AS n FROM {name}{k} GROUP BY {key}, pos // 8)""")
            ctes.append(f"{name}run{k} AS (SELECT {key}, pos // 8 AS up, list(d ORDER BY pos) AS run, max(n) AS n FROM {name}{k} GROUP BY {key}, pos // 8)")
        return ",\n".join(ctes)

    def steps(name: str, start: str, match: str, count: int) -> str:
        ctes, before = [], start
        for k in range(count):
            ctes.append(f"""{name}step{k} AS (SELECT s.* REPLACE (s.pos // 8 AS pos,
    CASE WHEN r.n > 1 THEN s.proof || array_to_string(r.run[1:s.pos % 8] || r.run[s.pos % 8 + 2:8], '') ELSE s.proof END AS proof,
    CASE WHEN r.n > 1 THEN sha256(array_to_string(r.run[1:s.pos % 8], '') || s.f || array_to_string(r.run[s.pos % 8 + 2:8], '')) ELSE s.f END AS f)
  FROM {before} s JOIN {name}run{k} r ON {match} AND r.up = s.pos // 8)""")
            before = f"{name}step{k}"
        return ",\n".join(ctes)

    part = lambda c, v=None: f"coalesce(strlen(CAST({v or c} AS VARCHAR)) || ':' || CAST({v or c} AS VARCHAR), '-')"
    fields = " || ".join(part(c) for c in FIELDS)
    changed = " || ".join(part(c, f"translate(text, '{UPPER}', '{LOWER}')" if c == "text" else None) for c in FIELDS)
    # crc32 of the id's digits, 8 steps a byte
    crc = "CAST(4294967295 AS BIGINT)"
    within = tree("w", "SELECT lang, pos, d, n FROM leaves", "lang", levels)
    over = tree("o", f"SELECT 0 AS g, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, d, count(*) OVER () AS n FROM w{levels}", "g", forest_levels)
    return f"""WITH RECURSIVE crc(doc_id, pos, k, c) AS (
  SELECT DISTINCT doc_id, 1, 0, {crc} FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT doc_id, CASE WHEN k = 7 THEN pos + 1 ELSE pos END, (k + 1) % 8,
    CASE WHEN x % 2 = 1 THEN xor(x // 2, CAST(3988292384 AS BIGINT)) ELSE x // 2 END
  FROM (SELECT *, CASE WHEN k = 0 THEN xor(c, CAST(ascii(substr(CAST(doc_id AS VARCHAR), pos, 1)) AS BIGINT)) ELSE c END AS x
        FROM crc WHERE pos <= length(CAST(doc_id AS VARCHAR)))),
hits AS (SELECT doc_id FROM crc WHERE k = 0 AND pos = length(CAST(doc_id AS VARCHAR)) + 1 AND xor(c, {crc}) % 3 = 0),
leaves AS (SELECT doc_id, lang, sha256({fields}) AS d, CASE WHEN doc_id IN (SELECT doc_id FROM hits) THEN sha256({changed}) ELSE sha256({fields}) END AS f,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, sha256({fields})) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM documents),
{within},
{over},
s AS (SELECT doc_id, lang, d AS leaf, f, pos, '' AS proof FROM leaves),
{steps("w", "s", "r.lang IS NOT DISTINCT FROM s.lang", levels)},
subroots AS (SELECT lang, d, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM w{levels}),
t AS (SELECT s.* REPLACE (b.place AS pos), b.d AS subroot FROM wstep{levels - 1} s JOIN subroots b ON b.lang IS NOT DISTINCT FROM s.lang),
{steps("o", "t", "true", forest_levels)}
SELECT doc_id, leaf, subroot, o.d AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = o.d AS verified
FROM ostep{forest_levels - 1} CROSS JOIN o{forest_levels} o"""


ORACLE = _oracle()
