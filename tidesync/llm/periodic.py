"""Periodic runs of words: maximal stretches that repeat one shortest unit at least ``EXPONENT`` times.

Dictionary of basic factors: the words of a text are named, then the factors of 2, 4, 8, ... words, a factor's name
being the pair of its halves' names. Factors that stand once in their text are left out, as no longer repeated factor
can hold them, so after a few levels little is left of ordinary prose. Where the next occurrences of a factor of length
``l`` stand in arithmetic progression with a difference of at most ``2 l``, the difference is proposed as a period: a run
of period q and 4 q words has such a progression at the level with q <= l < 2 q, and no smaller difference can come
first, so proposed periods of runs are smallest ones. Proposals are extended to both sides on the words and
deduplicated.

Texts are worked off in blocks of about ``BLOCK_WORDS`` words, a text whole in one block.

Defined results: null and empty texts have no words and no runs. Rows are judged one by one, so repeated rows and null
ids get equal results. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import let, plain_words, table

EXPONENT = 4                   # repeats of the unit that make a run
LEAST = 6                      # words that a run has at least
BLOCK_WORDS = 1 << 18
RUN = "array<struct<start:long,length:long,period:long>>"


# ---------------------------------------------------------------- proposals

def word_names(texts: list[list[bytes]]) -> np.ndarray:
    """A number for each word of the texts, in order; equal numbers are equal words of one text."""
    names, base = [], 0
    for words in texts:
        known: dict[bytes, int] = {}
        names.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)) + base)
        base += len(known)
    return np.concatenate(names) if names else np.empty(0, np.int64)


def next_same(names: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions with a later equal name, the next one's position), by ascending position; ``at`` ascends."""
    order = np.argsort(names, kind="stable")
    same = names[order[1:]] == names[order[:-1]]
    here, there = at[order[:-1][same]], at[order[1:][same]]
    by = np.argsort(here)
    return here[by], there[by]


def proposals(words: np.ndarray) -> list[tuple[int, int]]:
    """(start, period) of progressions of three successive occurrences, the first of each stretch of neighbours."""
    n, length = len(words), 1
    at, names = np.arange(n), words
    name_at, gap = np.empty(n, np.int64), np.empty(n, np.int64)
    found: set[tuple[int, int]] = set()
    while len(at):
        here, there = next_same(names, at)
        gap.fill(0)
        gap[here] = there - here
        near = here[there - here <= 2 * length]
        step = gap[near]
        third = near + step
        near, step = near[gap[third] == step], step[gap[third] == step]
        if len(near):
            first = np.ones(len(near), bool)
            first[1:] = (near[1:] != near[:-1] + 1) | (step[1:] != step[:-1])
            found.update(zip(near[first].tolist(), step[first].tolist(), strict=True))
        # next level: both halves are repeated factors
        name_at.fill(-1)
        twice = np.zeros(n, bool)
        twice[here] = twice[there] = True
        keep = twice[at]
        name_at[at[keep]] = names[keep]
        at = at[keep]
        at = at[at + length < n]
        at = at[name_at[at + length] >= 0]
        if not len(at):
            break
        pair = name_at[at] * (int(names.max()) + 1) + name_at[at + length]
        names = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        length *= 2
    return sorted(found, key=lambda p: (p[1], p[0]))


def _matches(words: np.ndarray, left: int, right: int, step: int) -> int:
    """How many words agree from ``left`` and ``right`` on (``step`` 1) or backwards (-1)."""
    count, size = 0, 16
    room = len(words) - right if step > 0 else left + 1
    while count < room:
        k = min(size, room - count)
        if step > 0:
            differ = words[left + count:left + count + k] != words[right + count:right + count + k]
        else:
            differ = (words[left - count - k + 1:left - count + 1] != words[right - count - k + 1:right - count + 1])[::-1]
        where = int(differ.argmax()) if differ.any() else k
        count += where
        if where < k:
            break
        size *= 2
    return count


def runs_of(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs, by start and period."""
    runs, period, reach = [], 0, 0
    for at, q in proposals(words):
        if q != period:
            period, reach = q, 0
        if at < reach:                 # inside what this period was extended to
            continue
        right = at + q + _matches(words, at, at + q, 1)
        start = at - (_matches(words, at - 1, at + q - 1, -1) if at else 0)
        reach = right - q
        if right - start >= max(LEAST, EXPONENT * q):
            runs.append((start, right - start, q))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def block_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Runs per text; the texts' names differ, so no run crosses from one to another."""
    ends = np.cumsum([len(t) for t in texts])
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in runs_of(word_names(texts)):
        i = int(np.searchsorted(ends, start, side="right"))
        found[i].append((start - int(ends[i]) + len(texts[i]), length, period))
    return found


# ---------------------------------------------------------------- the operator

def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, of each run only its first unit, joined by one space."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep)])


def _blocks(texts: Iterator) -> Iterator[list[list[bytes]]]:
    block, size = [], 0
    for value in texts:
        words = (value or "").encode().split()     # bytes split at ASCII whitespace alone
        block.append(words)
        size += len(words)
        if size >= BLOCK_WORDS:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) per row: the runs by start and period, and the text's words with each run
    cut to its first unit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            done = 0
            for texts in _blocks(v.as_py() for v in batch.column("text")):
                found = block_runs(texts)
                rows = [[{"start": s, "length": n, "period": q} for s, n, q in runs] for runs in found]
                yield pa.record_batch(
                    [batch.column("doc_id").slice(done, len(texts)), pa.array([len(t) for t in texts], pa.int64()), pa.array(rows, item),
                     pa.array([collapse(t, r).decode() for t, r in zip(texts, found, strict=True)], pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])
                done += len(texts)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, runs {RUN}, collapsed string")


# ---------------------------------------------------------------- the query

def planted(text: Column, doc_id: Column) -> Column:
    """The text; for a tenth of the ids its words from some word on repeat a unit (the contract's rule)."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeat(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        spot = lambda i: F.when(i >= a, a + (i - a) % p).otherwise(i)
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, spot(i).cast("int"))), " ")).otherwise(text)

    return F.when(doc_id.isNotNull() & (h % 10 == 0), let(plain_words(text), repeat)).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("text"))
    # greatest length, then smallest start, then smallest period
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                                    r["period"].cast("string"))), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    return (find_runs(docs).withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.s").alias("start"), (-F.col("best.l")).alias("length"),
        F.col("best.p").alias("period"), F.floor(-F.col("best.l") * 1000 / F.col("best.p")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))
