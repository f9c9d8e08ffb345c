"""Toxicity scores: gradient-boosted trees over dense text features, calibrated by isotonic regression.

The lexicon is learned: word beginnings that stand in toxic labelled documents far more often than in others.
Features are its densities, how near its hits are to second-person words, and the rates of capitals,
punctuation and obfuscated words. Training reads only labelled rows whose crc32(doc_id) mod 4 is not 2, at most
about ``MAX_LABELLED`` of them (drawn by a hash of the id); three quarters grow the trees, the rest calibrate.

Defined results: null and empty texts have zero features and get the model's score for them; a null doc_id is
not held out and never trains; a label that is null is ignored, of several labels of one id the largest counts;
without labels of both kinds every score is the share of toxic labels (0 with none). Equal rows get equal scores;
other columns are carried along and are no inputs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import carried, restored, saved, table

MAX_LABELLED = 24_000          # labelled training rows, about
STEM = range(4, 9)             # letters of a word's beginning
MIN_SHARE, MIN_SUPPORT = 1 / 600, 5    # toxic documents with a stem: as a share of the training rows, and at least
MIN_RATE = 0.6                 # their share of all that have it
THRESHOLD = 0.3
# Second-person words of the corpus's languages.
SECOND_PERSON = ("you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch",
                 "sie", "tu", "toi", "te", "vous", "votre", "ton", "ta", "tú", "ti", "usted", "ustedes", "vosotros")
NEAR = 40                      # characters around a hit that count as its proximity
_PERSON = re.compile(r"\b(?:" + "|".join(SECOND_PERSON) + r")\b")
_OBFUSCATED = re.compile(r"[a-z][*@$0-9!_]+[a-z]", re.I | re.A)
_CAPITALS = bytes(range(0x41, 0x5B))
_PUNCTUATION = b"!?.,;:"
_SYMBOLS = b"#*$%&|<>@_~^"
FEATURES = ["hits", "hit_density", "different_hits", "weight", "near_person", "capitals", "exclamations", "punctuation",
            "symbols", "digits", "obfuscated", "log_words", "word_length"]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def labelled_rows(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, text, toxic) of about ``limit`` labelled rows that are not held out."""
    known = saved(labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
                  .groupBy("doc_id").agg(F.max("toxic").cast("double").alias("toxic")))
    share = min(1.0, limit / max(known.count(), 1))
    drawn = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) < int(share * (1 << 20)))
    # about ``limit`` rows of two numbers
    return docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")


def learn_lexicon(rows: DataFrame, n_rows: int | None = None) -> dict[str, float]:
    """Word beginnings that mark toxic rows, with the (smoothed) share of toxic rows among those that have it. Of
    nested beginnings the shortest stays. Their number has no limit of its own: support is a share of the rows,
    so at most (beginnings in a row) / ``MIN_SHARE`` pass."""
    n_rows = rows.count() if n_rows is None else n_rows
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"(\p{L}{4,})"), 1))
    stems = F.array_distinct(F.flatten(F.transform(words, lambda w: F.array(*[F.substring(w, 1, k) for k in STEM]))))
    counts = (rows.select("toxic", F.explode(stems).alias("stem")).groupBy("stem")
              .agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")))
    best = counts.filter((F.col("toxic") >= max(MIN_SUPPORT, MIN_SHARE * n_rows)) & (F.col("toxic") / (F.col("n") + 1) >= MIN_RATE))
    found = {r["stem"]: r["toxic"] / (r["n"] + 1) for r in best.collect()}
    return {stem: found[stem] for stem in sorted(found) if not any(stem[:k] in found for k in range(min(STEM), len(stem)))}


def _features(text: str | None, automaton, weights: dict[str, float]) -> list[float]:
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.count(b" ") + raw.count(b"\n") + 1
    size = max(len(raw), 1)
    rate = lambda chars: (size - len(raw.translate(None, chars))) / size if raw else 0.0
    hits, seen, near = {}, set(), 0
    if automaton is not None:
        low = text.lower()
        for end, stem in automaton.iter(low):
            start = end - len(stem) + 1
            if start and low[start - 1].isalpha():
                continue
            hits[start] = max(hits.get(start, 0.0), weights[stem])
            seen.add(stem)
        for start in hits:
            if _PERSON.search(low, max(0, start - NEAR), start + NEAR):
                near += 1
    return [float(len(hits)), 100.0 * len(hits) / words, float(len(seen)), float(sum(hits.values())), near / words * 100.0,
            rate(_CAPITALS), rate(b"!"), rate(_PUNCTUATION), rate(_SYMBOLS), rate(b"0123456789"),
            100.0 * len(_OBFUSCATED.findall(text)) / words, float(np.log1p(words if raw else 0)), size / words if raw else 0.0]


def with_features(rows: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """``rows`` with ``features`` (array of double, as in FEATURES)."""
    own = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton() if lexicon else None
        for stem in lexicon:
            automaton.add_word(stem, stem)
        if lexicon:
            automaton.make_automaton()
        for batch in batches:
            made = [_features(t.as_py(), automaton, lexicon) for t in batch.column("text")]
            yield pa.record_batch([*[batch.column(c) for c in own], pa.array(made, pa.list_(pa.float64()))], names=[*own, "features"])

    kept = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in own)
    return rows.mapInArrow(run, f"{kept}, features array<double>")


class Model:
    """A fitted scorer; ``score`` adds the column ``score`` to rows with ``features``."""

    def __init__(self, lexicon: dict[str, float], trees, calibration, constant: float):
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant

    def score(self, rows: DataFrame) -> DataFrame:
        if self.trees is None:
            return rows.withColumn("score", F.lit(self.constant)).drop("features")
        own = [c for c in rows.columns if c != "features"]
        raw = self.trees.transform(rows.withColumn("features", array_to_vector("features")))
        raw = raw.withColumn("raw_score", F.get(vector_to_array("probability"), F.lit(1)))
        level = self.calibration.transform(raw)
        # the calibrated steps, with the trees' own order inside a step
        return level.select(*own, (0.995 * F.col("calibrated") + 0.005 * F.col("raw_score")).alias("score"))


def train(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> Model:
    """Lexicon, trees and calibration from labelled rows of ``docs`` that are not held out. A score is the calibrated
    step, with half a percent of the trees' own probability, which orders documents inside a step."""
    rows = saved(labelled_rows(docs, labels, limit))
    counts = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return Model({}, None, None, float(max(counts, default=0.0)))
    for_trees = F.pmod(F.xxhash64("doc_id", F.lit("split")), F.lit(4)) != 0
    lexicon = learn_lexicon(rows.filter(for_trees))
    featured = saved(with_features(rows, lexicon).drop("text")).withColumn("features", array_to_vector("features"))
    share = counts[1.0] / sum(counts.values())
    grown = featured.filter(for_trees)
    if grown.select("toxic").distinct().count() < 2 or featured.filter(~for_trees).isEmpty():
        return Model(lexicon, None, None, float(share))
    trees = GBTClassifier(labelCol="toxic", featuresCol="features", maxIter=15, maxDepth=4, stepSize=0.2, seed=7,
                          minInstancesPerNode=5, maxBins=64).fit(grown.coalesce(4))
    scored = trees.transform(featured.filter(~for_trees)) \
        .withColumn("raw_score", F.get(vector_to_array("probability"), F.lit(1)))
    calibration = IsotonicRegression(labelCol="toxic", featuresCol="raw_score", predictionCol="calibrated").fit(scored)
    return Model(lexicon, trees, calibration, float(share))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    scored = model.score(with_features(carried(docs, "doc_id", "text"), model.lexicon))
    return restored(scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")), docs.columns,
                    ["doc_id", "text"], ["score", "predicted"])


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_documents(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
