"""Line dedup by an exact set-similarity join.

A line is the set of its words. Lines of equal sets are first brought together (the earliest stands for them).
The words of a set are ordered by rarity, and only a set's first words (the prefix filter) are joined,
within bands of sizes; pairs that meet pass the length filter, the positional filter and a bound on their overlap
from 64-bit parity maps of the words (two for long sets), all inside the join. What is left is verified on the whole sets. A line is removed if an
earlier line has a Jaccard similarity of at least ``SIMILARITY``; earlier is by doc_id (null first), text hash
and line number, and it does not matter whether the earlier line is itself removed.

Rarity is read from a table of ``RARITY_CELLS`` counts, in which words share a cell by their hash: it gives a
total order of the words for any corpus in a fixed size, and the filters are exact under every total order.

Defined results: lines without a word are kept; null and empty texts have none; rows equal in id and text are one
document here and get equal results; other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .text import carried, checked_broadcast, join_docs, named, plain_words, restored, saved, table

SIMILARITY = (4, 5)            # 0.8, as a fraction, so that every bound is exact
RARITY_BITS = 19
CELLS_A_GROUP = 8              # counts kept in one row: the rows of a task then fit Spark's fast hash map
OTHER_BLANKS = "\t\x0b\x0c\r"
MAX_BROADCAST_ROWS = 200_000   # document keys (two numbers) sent to every executor at most
HOT_WORD = 1024
HOT_STEP = 40                  # floor(4 * log2(HOT_WORD)), as in ``rarity``
SIZE_BAND = 1.5                # sets that meet have sizes within one band of this ratio, or in neighbouring ones
LONG_SET = 64                  # sets of more words than one parity map has bits get two


def _spaced(text: Column) -> Column:
    """The text (empty for null) with blanks for all whitespace within its lines. Most texts have no other, which
    searches for bytes tell sooner than replacements or a pattern."""
    text = F.coalesce(text, F.lit(""))
    blank = reduce(lambda t, ch: F.replace(t, F.lit(ch), F.lit(" ")), OTHER_BLANKS, text)
    return F.when(reduce(lambda a, b: a | b, [F.contains(text, F.lit(ch)) for ch in OTHER_BLANKS]), blank).otherwise(text)


def _cell(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - RARITY_BITS)


def rarity(docs: DataFrame) -> DataFrame:
    """One row: for each cell, how common its words are in all documents (0 to 127, in even steps of the
    logarithm), as a long that flips the upper 8 bits of the cell's hashes to that."""
    spaced = F.replace(_spaced(F.col("text")), F.lit("\n"), F.lit(" "))
    words = docs.select(F.explode_outer(F.split(spaced, " ", -1)).alias("word")).filter("word != ''").select(_cell(F.xxhash64("word")).alias("cell"))
    places, bits = range(CELLS_A_GROUP), CELLS_A_GROUP.bit_length() - 1
    place = F.col("cell").bitwiseAND(F.lit(CELLS_A_GROUP - 1).cast("long"))
    counts = words.groupBy(F.shiftright("cell", bits).alias("group")).agg(*[F.count_if(place == i).alias(f"n{i}") for i in places])

    def flip(i: int) -> Column:
        n = F.col(f"n{i}")
        step = F.when(n > 0, F.least(F.floor(4 * F.log2(n)), F.lit(127))).otherwise(0).cast("long")
        cell = F.col("group") * CELLS_A_GROUP + i
        return F.shiftleft(F.coalesce(step, F.lit(0).cast("long")).bitwiseXOR(F.shiftright(cell, RARITY_BITS - 8)), 56)

    full = docs.sparkSession.range(1 << (RARITY_BITS - bits)).select(F.col("id").alias("group"))
    groups = full.join(counts, "group", "left").select("group", F.array(*[flip(i) for i in places]).alias("steps"))
    # groups in blocks, so that no task sorts more than a block
    blocks = groups.groupBy(F.shiftright("group", 6).alias("block")).agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("group", "steps"))), lambda g: g["steps"])).alias("steps"))
    return saved(blocks).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("block", "steps"))),
                                                   lambda b: b["steps"])).alias("steps"))


def word_keys(line: Column, steps: Column) -> Column:
    """The distinct words of a line (of ``_spaced`` text) as numbers, rarest first: 7 bits of rarity, then 56 of the
    word's hash. ``steps`` flips the hash's upper bits to the rarity; no element is null, so that the numbers are sorted
    as longs. The empty words between blanks go as one number; the lambdas are interpreted, so few steps are in them
    (under ANSI an element of ``steps`` cannot be null, and Spark leaves out the step that says so)."""
    hashes = F.array_distinct(F.transform(F.split(line, " ", -1), lambda w: F.xxhash64(w)))
    return F.sort_array(F.transform(F.array_remove(hashes, F.xxhash64(F.lit(""))), lambda h: (
        h.bitwiseXOR(F.coalesce(steps[_cell(h)], F.lit(0).cast("long"))))))


def _parity(keys: Column, bit: Callable[[Column], Column]) -> Column:
    """64 bits: the words whose ``bit`` is 1, each flipping the bit its hash names."""
    return F.aggregate(keys, F.lit(0).cast("long"), lambda acc, k: acc.bitwiseXOR(
        F.call_function("shiftleft", bit(k), k.bitwiseAND(F.lit(63).cast("long")).cast("int"))))


def line_sets(docs: DataFrame) -> DataFrame:
    """(h1, b1, b2, first, size, prefix): each distinct word set, its first line and its filters (the parity map of
    all words, and of one half of the hash space for long sets). Equal sets are equal in the hash and maps."""
    p, q = SIMILARITY
    steps = rarity(docs).scalar()
    lines = named(docs, lines=F.split(_spaced(F.col("text")), "\n", -1)) \
        .select("doc_id", "text_hash", F.posexplode_outer("lines").alias("line", "words"))
    # the table is one array for all rows: the two selects become one, where it is read in place
    keyed = lines.select("*", steps.alias("steps")).select(
        "doc_id", "text_hash", "line", word_keys(F.col("words"), F.col("steps")).alias("keys"))
    size = F.size("keys")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    odd = _parity(F.col("keys"), lambda k: F.shiftrightunsigned(k, 6).bitwiseAND(one))
    return (keyed.select(
        F.xxhash64("keys").alias("h1"),
        F.struct("doc_id", "text_hash", "line").alias("first"), size.alias("size"),
        F.slice("keys", 1, size - F.ceil(size * p / F.lit(float(q)) - 1e-9).cast("int") + 1).alias("prefix"),
        _parity(F.col("keys"), lambda k: one).alias("b1"), F.when(size > LONG_SET, odd).otherwise(zero).alias("b2"))
        .groupBy("h1", "b1", "b2").agg(F.min("first").alias("first"), F.first("size").alias("size"), F.first("prefix").alias("prefix"))
        .filter("size > 0"))                   # after the grouping: before it, the words would be found twice


def _short(key: Column) -> Column:
    """32 bits for a word, half the room in the shuffle of the postings. A pair of similar sets meets at its first common
    word in any case; words that share these bits only bring more pairs to the filters and the verification."""
    return F.hash(key)


def placed(postings: DataFrame) -> DataFrame:
    """Size and place of the word in one number, which takes less room in the shuffle."""
    place = F.shiftleft(F.col("size").cast("long"), 32).bitwiseOR(F.col("at").cast("long"))
    return postings.withColumn("place", place).drop("size", "at")


def _size(side: str) -> Column:
    return F.shiftright(F.col(f"{side}.place"), 32)


def _at(side: str) -> Column:
    return F.col(f"{side}.place").bitwiseAND(F.lit((1 << 32) - 1))


def _may_be_similar(a: str, b: str) -> Column:
    """Length, position and overlap filters of two postings with a common word, in whole numbers: similar sets of ``n``
    words together have at least p / (p + q) * n in common, so at most (q - p) / (p + q) * n in one set alone."""
    p, q = SIMILARITY
    n = _size(a) + _size(b)
    # the first common word leaves at most this many common words
    left = F.least(_size(a) - _at(a), _size(b) - _at(b))
    every, half = (F.col(f"{a}.{m}").bitwiseXOR(F.col(f"{b}.{m}")) for m in ("b1", "b2"))
    differ = F.when((_size(a) > LONG_SET) & (_size(b) > LONG_SET),
                    F.bit_count(half) + F.bit_count(every.bitwiseXOR(half))).otherwise(F.bit_count(every))
    return ((p + q) * left >= p * n) & ((p + q) * differ <= (q - p) * n)


def _band(size: Column) -> Column:
    return F.floor(F.log(SIZE_BAND, size)).cast("int")


def banded(postings: DataFrame) -> DataFrame:
    """Cold postings with one key for a word and a band of sizes: each in its set's band, and in those of all larger sets
    that the set can be similar to if this is their first common word (few words before it leave room for few sizes)."""
    p, q = SIMILARITY
    largest = F.floor((q * F.col("size") - (p + q) * F.col("at")) / F.lit(p))
    bands = F.sequence(_band(F.col("size")), _band(F.greatest(F.col("size"), largest)))
    return postings.withColumn("band", F.explode(bands)).withColumn("key", F.hash("key", "band")).drop("band")


def _pairs(a: DataFrame, b: DataFrame, order: Column) -> DataFrame:
    """(h1, other) of postings ``a`` and ``b`` with a common word that pass the filters."""
    return (a.alias("a").join(b.alias("b"), (F.col("a.key") == F.col("b.key")) & order & _may_be_similar("a", "b"))
            .select(F.col("a.h1").alias("h1"), F.col("b.h1").alias("other")).distinct())


def verified(docs: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """(h1, first): the later set of each pair that is similar, judged on the words of both lines."""
    p, q = SIMILARITY
    needed = sets.select("h1", "first.*").join(
        pairs.select("h1").unionByName(pairs.select(F.col("other").alias("h1"))).distinct(), "h1")
    wanted = saved(needed.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("line", "h1")).alias("wanted")))
    keys = checked_broadcast(wanted.select("doc_id", "text_hash"), MAX_BROADCAST_ROWS)
    texts = join_docs(named(docs, text=F.col("text")), keys, "left_semi")
    # rows equal in id and text give a set's line more than once
    whole = (join_docs(texts, wanted).withColumn("lines", F.split("text", "\n", -1))
                  .select("doc_id", "text_hash", F.explode(F.transform("wanted", lambda w: F.struct(
                      w["h1"].alias("h1"), w["line"].alias("line"), F.get("lines", w["line"]).alias("words")))).alias("w"))
                  .select("w.h1", F.struct("doc_id", "text_hash", "w.line").alias("first"), "w.words")
                  .dropDuplicates(["h1"])
                  .withColumn("words", F.array_distinct(plain_words(F.col("words")))))
    # in Parquet, where words take a fraction of a checkpoint's room; its small files say little of the rows' size
    path = scratch_path(docs.sparkSession, "line-words")
    whole.write.parquet(path)
    whole = docs.sparkSession.read.parquet(path).hint("merge")
    other = whole.select(F.col("h1").alias("other"), F.col("first").alias("other_first"), F.col("words").alias("other_words"))
    common = F.size(F.array_intersect("words", "other_words"))
    words = F.size("words") + F.size("other_words")
    later = F.greatest(F.struct("first", "h1"), F.struct(F.col("other_first").alias("first"), F.col("other").alias("h1")))
    similar = (p + q) * common >= p * words          # q * common >= p * (words - common), with the common words found once
    return (pairs.join(whole, "h1").join(other.hint("merge"), "other").filter(similar)
            .select(later.alias("later")).select("later.h1", "later.first").distinct())


def later_matches(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(h1, first): the sets that an earlier set is similar to.

    Words that stand ``HOT_WORD`` times or more may bring very many similar lines together, of which all pairs
    would be too many. Under such a word every set first meets the earliest one alone; only sets that this
    does not settle meet all earlier ones.
    """
    postings = sets.select(F.posexplode("prefix").alias("at", "key"), "h1", "size", "b1", "b2")
    is_hot = F.shiftrightunsigned("key", 56) >= HOT_STEP
    # a word of rarity 0 is alone in its cell: it stands once in all documents and can meet nothing
    cold = postings.filter(~is_hot & (F.shiftrightunsigned("key", 56) > 0)).withColumn("key", _short(F.col("key")))
    cold = placed(banded(cold))
    # the smaller set meets the larger, in whose band it is, too
    smaller = (_size("a") <= _size("b")) & ((_size("a") < _size("b")) | (F.col("a.h1") < F.col("b.h1"))) & (F.col("a.h1") != F.col("b.h1"))
    pairs = _pairs(cold, cold, smaller) \
        .select(F.least("h1", "other").alias("h1"), F.greatest("h1", "other").alias("other"))
    hot = saved(placed(sets.select(F.posexplode("prefix").alias("at", "key"), "h1", "size", "b1", "b2", "first").filter(is_hot)))
    if hot.isEmpty():
        return verified(docs, sets, saved(pairs))
    earliest = hot.groupBy("key").agg(F.min(F.struct("first", "h1", "place", "b1", "b2")).alias("e")).select("key", "e.*")
    # judged together with the cold words' pairs, as each judgement reads the texts
    met = _pairs(hot, earliest, F.col("a.first") > F.col("b.first")).select(F.least("h1", "other").alias("h1"), F.greatest("h1", "other").alias("other"))
    found = saved(verified(docs, sets, saved(pairs.unionByName(met).distinct())))
    open_ = hot.join(found, "h1", "left_anti")
    rest = verified(docs, sets, saved(_pairs(open_, hot, F.col("a.first") > F.col("b.first"))))
    return found.unionByName(rest).distinct()


def kept_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, kept): numbers of the lines with words that stay, for documents that have any."""
    spark = docs.sparkSession
    path = scratch_path(spark, "line-sets")
    line_sets(docs).write.parquet(path)
    sets = spark.read.parquet(path)
    removed = later_matches(docs, sets).select("h1", F.lit(True).alias("removed"))
    return (sets.select("h1", "first").join(removed, "h1", "left").filter("removed is null").select("first.*")
            .groupBy("doc_id", "text_hash").agg(F.collect_list("line").alias("kept")))


def remove_lines(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) with ``n_lines`` and ``n_removed`` (of lines with a word); ``text`` without the
    removed lines."""
    kept = kept_lines(docs).withColumnRenamed("kept", "kept_lines")
    own = carried(docs, "doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    worded = lambda x: x.rlike(r"[^\x20\x09-\x0D]")
    lines = F.split("text", "\n", -1)
    stay = F.filter(lines, lambda x, i: ~worded(x) | F.coalesce(F.array_contains("kept_lines", i), F.lit(False)))
    n_lines = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n", -1), worded))
    done = (join_docs(own, kept, "left").withColumn("n_lines", n_lines.cast("long"))
            .withColumn("n_removed", F.col("n_lines") - F.coalesce(F.size("kept_lines"), F.lit(0)))
            .withColumn("text", F.when(F.col("n_removed") > 0, F.array_join(stay, "\n")).otherwise(F.col("text"))))
    return restored(done, docs.columns, ["doc_id", "text"], ["n_lines", "n_removed"])


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE = r"""
WITH l AS (SELECT doc_id, i, lines[i] AS line FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
w AS (SELECT doc_id, i, line, list_sort(list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS s FROM l),
v AS (SELECT * FROM w WHERE len(s) > 0),
k AS (SELECT s, min(doc_id * 1000000 + i) AS first, len(s) AS n, row_number() OVER () AS id FROM v GROUP BY s),
t AS (SELECT id, n, unnest(s) AS word FROM k),
f AS (SELECT word, count(*) AS df FROM t GROUP BY word),
o AS (SELECT id, n, t.word, row_number() OVER (PARTITION BY id ORDER BY df, t.word) AS place FROM t JOIN f ON t.word = f.word),
p AS (SELECT * FROM o WHERE place <= n - ceil(0.8 * n - 1e-9) + 1),
c AS (SELECT DISTINCT a.id AS x, b.id AS y FROM p a JOIN p b ON a.word = b.word AND a.id < b.id
        AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n),
j AS (SELECT greatest(x.first, y.first) AS later FROM c JOIN k x ON x.id = c.x JOIN k y ON y.id = c.y
        WHERE 5 * len(list_intersect(x.s, y.s)) >= 4 * (x.n + y.n - len(list_intersect(x.s, y.s)))),
z AS (SELECT w.*, len(w.s) = 0 OR (k.first = doc_id * 1000000 + i AND k.first NOT IN (SELECT later FROM j)) AS stays
        FROM w LEFT JOIN k ON w.s = k.s)
SELECT doc_id, CAST(count(*) FILTER (len(s) > 0) AS BIGINT) AS n_lines, CAST(count(*) FILTER (NOT stays) AS BIGINT) AS n_removed,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (stays), '')) AS kept_sha256 FROM z GROUP BY doc_id
"""
