"""Benchmark decontamination with a positional inverted index of the training documents.

The terms of the benchmark are counted over all documents; each 13-word window of an item is looked up
by its two rarest terms. Only postings of such terms are stored. Their positions, less the term's place
in the item, give alignments (document, item, offset); windows whose rarest terms meet at one offset are
then verified against the document's words.

Defined results: null and empty documents have no words, no hits and are not contaminated; null and
empty items match nothing; an item id that is null is never listed, though its words count as hit; items
of equal words are looked up once. Rows equal in id and text get equal results. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .text import carried, checked_broadcast, folded_words, join_docs, named, restored, saved, table

N = 13                          # words of a window
NEAR_ANCHORS, SLOP = 4, 3       # of a proximity match: terms of a window that are looked up, words they may be off
MAX_BROADCAST_ROWS = 200_000    # term or document keys (two longs) sent to every executor at most


def benchmark_items(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct word sequences (item, item_words) and the ids that have each (item, item_id)."""
    worded = benchmark.select(F.col("item_id").cast("string").alias("item_id"),
                              folded_words(F.col("text")).alias("item_words")) \
        .filter(F.size("item_words") > 0).withColumn("item", F.xxhash64("item_words"))
    return (saved(worded.groupBy("item").agg(F.first("item_words").alias("item_words"))),
            worded.filter(F.col("item_id").isNotNull()).select("item", "item_id").distinct())


def term_counts(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(term, n) over all documents for the benchmark's terms that occur at all."""
    vocabulary = saved(items.select(F.explode("item_words").alias("word")).select(F.xxhash64("word").alias("term")).distinct())
    tokens = docs.select(F.explode_outer(folded_words(F.col("text"))).alias("word")).filter("word is not null") \
        .select(F.xxhash64("word").alias("term"))
    return saved(tokens.join(checked_broadcast(vocabulary, MAX_BROADCAST_ROWS), "term").groupBy("term").agg(F.count("*").alias("n")))


def _windows(items: DataFrame, counts: DataFrame) -> DataFrame:
    """(item, n_item, start, place, word, term, n): the places of each window; ``n`` is null for a term that no document has."""
    places = (items.select("item", F.size("item_words").alias("n_item"), F.posexplode("item_words").alias("place", "word"))
              .withColumn("term", F.xxhash64("word")).join(counts, "term", "left"))
    first = F.greatest(F.lit(0), F.col("place") - (N - 1))
    last = F.least(F.col("place"), F.greatest(F.lit(0), F.col("n_item") - N))
    return places.withColumn("start", F.explode(F.sequence(first, last)))


def window_anchors(items: DataFrame, counts: DataFrame) -> DataFrame:
    """(item, start, width, anchors): each window with its two rarest places (item positions). Windows with
    a term that no document has cannot occur and are left out."""
    rarest = F.array_sort(F.collect_list(F.struct("n", "term", "place")))
    return (_windows(items, counts).groupBy("item", "start", F.least(F.col("n_item"), F.lit(N)).alias("width"))
            .agg(F.slice(rarest, 1, 2).alias("rarest"), F.count("n").alias("known"))
            .filter(F.col("known") == F.col("width")).drop("known"))


def near_anchors(items: DataFrame, counts: DataFrame) -> DataFrame:
    """(item, start, rarest): each window with the ``NEAR_ANCHORS`` rarest of its places whose terms occur at all; a word
    that no document has may be the one that was changed. Windows with fewer than two such places are left out."""
    rarest = F.array_sort(F.collect_list(F.struct("n", "word", "place", "term")))
    return (_windows(items, counts).filter("n is not null").groupBy("item", "start")
            .agg(F.slice(rarest, 1, NEAR_ANCHORS).alias("rarest")).filter(F.size("rarest") > 1))


def alignments(docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item, offset, places): the item places whose term stands in the document at
    ``offset + place``. ``anchors``: (term, item, place)."""
    terms = anchors.select("term").distinct()
    postings = (named(docs, words=folded_words(F.col("text")))
                .select("doc_id", "text_hash", F.posexplode_outer("words").alias("pos", "word")).filter("word is not null")
                .select("doc_id", "text_hash", "pos", F.xxhash64("word").alias("term"))
                .join(checked_broadcast(terms, MAX_BROADCAST_ROWS), "term"))
    return (saved(postings).join(anchors, "term")
            .groupBy("doc_id", "text_hash", "item", (F.col("pos") - F.col("place")).alias("offset"))
            .agg(F.collect_set("place").alias("places")))


def covered_words(spans: Column) -> Column:
    """Words covered by ``spans`` (start, width), each word once."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total"))

    def add(state: Column, span: Column) -> Column:
        end = span["start"] + span["width"]
        new = F.greatest(F.lit(0), end - F.greatest(span["start"], state["end"]))
        return F.struct(F.greatest(state["end"], end).alias("end"), (state["total"] + new).alias("total"))

    return F.aggregate(F.array_sort(spans), start, add, lambda s: s["total"])


def phrase_matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item, spans): the verified places (start, width) of an item's windows."""
    windows = saved(window_anchors(items, term_counts(docs, items)))
    anchors = saved(windows.select("item", F.explode("rarest").alias("r")).select("r.term", "item", "r.place").distinct())
    aligned = alignments(docs, anchors)
    per_item = windows.groupBy("item").agg(F.collect_list(F.struct(
        "start", "width", F.transform("rarest", lambda r: r["place"]).alias("at"))).alias("windows"))
    meet = F.filter("windows", lambda w: F.size(F.array_except(w["at"], F.col("places"))) == 0)
    candidates = saved(aligned.join(per_item, "item")
                       .select("doc_id", "text_hash", "item", "offset",
                               F.transform(meet, lambda w: F.struct(w["start"].alias("start"), w["width"].alias("width"))).alias("met"))
                       .filter(F.size("met") > 0))
    keys = checked_broadcast(candidates.select("doc_id", "text_hash").distinct(), MAX_BROADCAST_ROWS)
    texts = (join_docs(named(docs, text=F.col("text")), keys, "left_semi").dropDuplicates(["doc_id", "text_hash"])
             .withColumn("words", folded_words(F.col("text"))).drop("text"))
    judged = join_docs(candidates, texts).join(items, "item")
    equal = F.filter("met", lambda w: F.slice("words", F.col("offset") + w["start"] + 1, w["width"])
                     == F.slice("item_words", w["start"] + 1, w["width"]))
    # an offset may be negative: an item that starts before the document holds only its later windows
    inside = F.filter("met", lambda w: F.col("offset") + w["start"] >= 0)
    spans = F.transform("met", lambda w: F.struct((F.col("offset") + w["start"]).alias("start"), w["width"].alias("width")))
    return (judged.withColumn("met", inside).withColumn("met", equal).filter(F.size("met") > 0)
            .select("doc_id", "text_hash", "item", spans.alias("spans")))


def proximity_matches(docs: DataFrame, benchmark: DataFrame, slop: int = SLOP) -> DataFrame:
    """(doc_id, text_hash, item_id): documents near an item. A window of the item is near where all of its anchors but one
    (two at least) stand as far apart as in the item, give or take ``slop`` words; the one left out may be a changed word.
    Every exact match of a window with two words or more is near as well."""
    items, ids = benchmark_items(benchmark)
    windows = saved(near_anchors(items, term_counts(docs, items)))
    anchors = saved(windows.select("item", F.explode("rarest").alias("r")).select("r.term", "item", "r.place").distinct())
    # places of one document that stand at most ``slop`` words off: a frame holds ``slop`` + 1 offsets
    frame = Window.partitionBy("doc_id", "text_hash", "item").orderBy("offset").rangeBetween(0, slop)
    found = (alignments(docs, anchors).withColumn("places", F.array_distinct(F.flatten(F.collect_list("places").over(frame))))
             .filter(F.size("places") > 1))
    at = F.transform("rarest", lambda r: r["place"])
    per_item = windows.groupBy("item").agg(F.collect_set(at).alias("windows"))
    near = F.exists("windows", lambda w: F.size(F.array_intersect(w, F.col("places"))) >= F.greatest(F.lit(2), F.size(w) - 1))
    return (found.join(per_item, "item").filter(near).select("doc_id", "text_hash", "item").distinct()
            .join(ids, "item").select("doc_id", "text_hash", "item_id").distinct())


def near_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_near, near_sha256) for every document: how many items it is near, and the digest of their ids."""
    listed = (proximity_matches(docs, benchmark).groupBy("doc_id", "text_hash")
              .agg(F.array_sort(F.collect_set("item_id")).alias("item_ids")))
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return join_docs(named(docs), listed, "left").select(
        "doc_id", "text_hash", F.size(ids).cast("long").alias("n_near"), F.sha2(F.array_join(ids, ","), 256).alias("near_sha256"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated) for every document."""
    items, ids = benchmark_items(benchmark)
    matches = saved(phrase_matches(docs, items))
    hits = matches.select("doc_id", "text_hash", F.explode("spans").alias("span")).groupBy("doc_id", "text_hash").agg(
        covered_words(F.collect_set("span")).alias("n_hit"))
    listed = (matches.select("doc_id", "text_hash", "item").distinct().join(ids, "item")
              .groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids")))
    base = named(docs, n_words=F.size(folded_words(F.col("text"))).cast("long"))
    none = F.array().cast("array<string>")
    return (join_docs(base, join_docs(hits, listed, "left"), "left")
            .select("doc_id", "text_hash", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("item_ids", none).alias("item_ids"))
            .select("doc_id", "text_hash", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                    F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                    ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated ones."""
    bad = saved(decontaminate(docs, benchmark).filter("contaminated").select("doc_id", "text_hash").distinct())
    own = carried(docs, "doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    return restored(join_docs(own, checked_broadcast(bad, MAX_BROADCAST_ROWS), "left_anti"), docs.columns, ["doc_id", "text"], [])


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


def benchmark_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


ORACLE = rf"""
WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), {N}) AS width, array_to_string(w[s:s+{N - 1}], ' ') AS win
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {N - 1}, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
wd AS (SELECT DISTINCT width FROM iw),
dw AS (SELECT doc_id, s, width, array_to_string(w[s:s+width-1], ' ') AS win
        FROM (SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS s FROM d, wd WHERE len(w) >= width)),
m AS (SELECT doc_id, s, dw.width, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.width = iw.width),
sp AS (SELECT DISTINCT doc_id, s, width FROM m),
e AS (SELECT doc_id, s, s + width AS f, coalesce(max(s + width) OVER (PARTITION BY doc_id ORDER BY s, width
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM sp),
h AS (SELECT doc_id, CAST(sum(greatest(0, f - greatest(s, b))) AS BIGINT) AS n_hit FROM e GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
        array_to_string(list_sort(list(DISTINCT item_id)), ',') AS ids FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""

PROXIMITY_ORACLE = rf"""
WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
ip AS (SELECT item_id, len(w) AS n_item, unnest(w) AS word, unnest(range(len(w))) AS place FROM i),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
dp AS (SELECT * FROM (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM d) WHERE word IN (SELECT word FROM ip)),
c AS (SELECT word, count(*) AS n FROM dp GROUP BY word),
wp AS (SELECT item_id, place, word, n, unnest(range(greatest(0, place - {N - 1}), least(place, greatest(0, n_item - {N})) + 1)) AS start
        FROM ip JOIN c USING (word)),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id, start ORDER BY n, word, place) AS k,
        count(*) OVER (PARTITION BY item_id, start) AS known FROM wp),
a AS (SELECT item_id, start, place, word, least(known, {NEAR_ANCHORS}) AS m FROM r WHERE k <= {NEAR_ANCHORS} AND known > 1),
al AS (SELECT doc_id, a.item_id, start, m, place, pos - place AS o FROM dp JOIN a ON dp.word = a.word),
x AS (SELECT doc_id, item_id, m, count(DISTINCT place) OVER (PARTITION BY doc_id, item_id, start ORDER BY o
        RANGE BETWEEN CURRENT ROW AND {SLOP} FOLLOWING) AS here FROM al),
t AS (SELECT doc_id, array_to_string(list_sort(list(DISTINCT item_id)), ',') AS ids, count(DISTINCT item_id) AS n_near
        FROM x WHERE here >= greatest(2, m - 1) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_near, 0) AS n_near, sha256(coalesce(ids, '')) AS near_sha256 FROM d LEFT JOIN t ON d.doc_id = t.doc_id
"""
