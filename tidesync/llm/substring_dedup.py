"""Substring dedup by relative Lempel-Ziv parsing against a distributed reference.

The reference is the whole corpus. Its index is cut into blocks by seed: in every window of ``WINDOW`` words
the run of ``SEED`` words with the smallest hash is the window's seed, so equal windows have equal seeds and
meet in one block. Each document is parsed against every block that holds one of its seeds: within a block,
greedily, the longest run of consecutive windows that continue one earlier place becomes a factor
(start, words, source place). A factor has at least ``WINDOW`` words. Windows that straddle a factor's end
belong to the next seed and are judged in its block, so factors that touch or overlap are joined at their
boundaries and no window is missed.

Repeats inside one batch of documents are found before the shuffle, and a block remembers one place for
each distinct window, so a passage in a third of all documents neither gathers in one task nor grows there.
A phrase shorter than a window can be the seed of very many distinct windows. Seeds are therefore counted first,
in ``CELLS`` cells of their hash; under the seeds of a hot cell every window is a block of its own, keyed by seed
and window, so equal windows still meet and distinct ones scatter. A block gets at most one row per batch then.

Windows are compared by the seed's 64-bit hash and 48 more bits of the window.

Defined results: null and empty texts have no words, nothing is removed; texts shorter than a window lose
nothing; rows equal in id and text are separate documents (so both lose what they share). Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .text import join_docs, named, saved, table
from .wordhash import combine, window_hashes, window_minimum, word_hashes

WINDOW, SEED = 35, 8
BATCH_WORDS = 1 << 18                  # words hashed together, about; only a longer text has more
PIECE = 6                              # bytes of a window's hash in a seed row
CELL_BITS = 17
CELLS = 1 << CELL_BITS                 # counters of seed rows
HOT_ROWS, MOST_ROWS = 4096, 1 << 16    # rows of a cell beyond which it is hot; see hot_cells
ROUTED = "seed long, doc_id {id}, text_hash long, start int, length int, windows binary"
FACTORS = "doc_id {id}, text_hash long, start int, length int, source_hash long, source_start int"


def _runs(same: np.ndarray) -> np.ndarray:
    """Starts of runs, given for each element but the first whether it continues its run."""
    return np.concatenate([[0], np.flatnonzero(~same) + 1])


def _seed_runs(words: list[np.ndarray], window: int) -> tuple | None:
    """(all words, where each document begins, places of the windows, their documents, first and last window of
    each run of one seed, the runs' seeds)."""
    every = np.concatenate(words)
    sizes = np.array([len(w) for w in words])
    begin = np.concatenate([[0], np.cumsum(sizes)])
    if len(every) < window:
        return None
    doc = np.repeat(np.arange(len(words)), sizes)[:len(every) - window + 1]
    valid = np.arange(len(doc)) + window <= begin[doc + 1]
    seeds = window_hashes(every, SEED)
    at = window_minimum(seeds, window - SEED + 1)
    keep = np.flatnonzero(valid)
    if not len(keep):
        return None
    doc, at = doc[keep], at[keep]
    first = _runs((at[1:] == at[:-1]) & (keep[1:] == keep[:-1] + 1))
    last = np.append(first[1:], len(keep))
    seed = combine(seeds[at[first]], np.full(len(first), 1, np.uint64))
    return every, begin, keep, doc, first, last, seed


def _cells(seed: np.ndarray) -> np.ndarray:
    return (seed >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _routed(batch: pa.RecordBatch, rows: list[int], words: list[np.ndarray], window: int, hot: np.ndarray) -> pa.RecordBatch | None:
    """Seed rows of some documents and, for what repeats among them, spans (``windows`` null). Seeds of the
    cells ``hot`` (a flag for each) give a row for each window."""
    found = _seed_runs(words, window)
    if found is None:
        return None
    every, begin, keep, doc, first, last, seed = found
    hashes = window_hashes(every, window)[keep]
    # windows whose seed repeats in this batch: later ones of equal windows are settled here
    _, which, count = np.unique(seed, return_inverse=True, return_counts=True)
    twice = np.repeat(count[which] > 1, last - first)
    settled, later = np.zeros(len(keep), bool), np.zeros(len(keep), bool)
    here = np.flatnonzero(twice)
    if len(here):
        _, one, group, n = np.unique(hashes[here], return_index=True, return_inverse=True, return_counts=True)
        settled[here] = n[group] > 1
        later[here] = settled[here]
        later[here[one]] = False
    scatter = hot[_cells(seed)]
    send = np.flatnonzero((np.add.reduceat(~later, first) > 0) & ~scatter)
    lone = np.flatnonzero(np.repeat(scatter, last - first) & ~later)
    start = keep - begin[doc]
    spans = np.flatnonzero(settled)
    cut = _runs((spans[1:] == spans[:-1] + 1) & (keep[spans[1:]] == keep[spans[:-1]] + 1)) if len(spans) else np.empty(0, int)
    ends = np.append(cut[1:], len(spans)) if len(cut) else cut
    span_at = spans[cut] if len(cut) else spans
    number = np.array(rows)
    ids = np.concatenate([number[doc[first[send]]], number[doc[lone]], number[doc[span_at]]])
    chosen = np.repeat(np.isin(np.arange(len(first)), send, assume_unique=True), last - first)
    pieces = np.concatenate([hashes[chosen], hashes[lone]])
    payload = np.ascontiguousarray(pieces.view(np.uint8).reshape(-1, 8)[:, :PIECE]).tobytes()
    lengths = np.concatenate([last[send] - first[send], np.ones(len(lone), int)]) * PIECE
    offsets = np.concatenate([[0], np.cumsum(lengths), np.full(len(span_at), lengths.sum())]).astype(np.int32)
    full = np.concatenate([np.ones(len(lengths), bool), np.zeros(len(span_at), bool)])
    binary = pa.Array.from_buffers(pa.binary(), len(full), [pa.array(full).buffers()[1], pa.py_buffer(offsets), pa.py_buffer(payload)])
    text_hash = batch.column("text_hash").take(pa.array(ids))
    own_key = combine(np.repeat(seed, last - first)[lone], hashes[lone])
    key = np.concatenate([seed[send].view(np.int64), own_key.view(np.int64),
                          text_hash.to_numpy(zero_copy_only=False)[len(lengths):].astype(np.int64)])
    return pa.record_batch({
        "seed": pa.array(key), "doc_id": batch.column("doc_id").take(pa.array(ids)), "text_hash": text_hash,
        "start": pa.array(np.concatenate([start[first[send]], start[lone], start[span_at]]).astype(np.int32)),
        "length": pa.array(np.concatenate([last[send] - first[send], np.ones(len(lone), int), ends - cut]).astype(np.int32) + window - 1),
        "windows": binary})


def _bundles(batch: pa.RecordBatch, window: int) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Rows of a batch and the hashed words of each, about BATCH_WORDS words at a time."""
    rows, words, size = [], [], 0
    for i, text in enumerate(batch.column("text")):
        value = text.as_py()
        if value is None:
            continue
        hashed = word_hashes(value.encode("utf-8", "surrogatepass"))
        if len(hashed) < window:
            continue
        rows.append(i)
        words.append(hashed)
        size += len(hashed)
        if size >= BATCH_WORDS:
            yield rows, words
            rows, words, size = [], [], 0
    if rows:
        yield rows, words


def hot_cells(docs: DataFrame, window: int) -> np.ndarray:
    """A flag for each cell of seeds: whether it has over ``HOT_ROWS`` seed rows and over four times the mean, or
    over ``MOST_ROWS``. A hot seed's cell is always hot; other seeds of the cell only take more rows for it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for _, words in _bundles(batch, window):
                if (found := _seed_runs(words, window)) is not None:
                    total += np.bincount(_cells(found[-1]), minlength=CELLS)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["cell", "n"])

    counts = saved(docs.select("text").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")))
    rows = counts.agg(F.sum("n")).first()[0] or 0
    limit = min(max(HOT_ROWS, 4 * rows // CELLS), MOST_ROWS)
    hot = np.zeros(CELLS, bool)
    hot[[r["cell"] for r in counts.filter(F.col("n") > limit).collect()]] = True
    return hot


def route(window: int, hot: np.ndarray):
    """Documents -> rows for the blocks of the reference."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, words in _bundles(batch, window):
                if (out := _routed(batch, rows, words, window, hot)) is not None:
                    yield out
    return run


class _Block:
    """One block of the reference: the first place of each distinct window under one seed."""

    def __init__(self, window: int):
        self.window, self.places = window, {}

    def parse(self, row: tuple, out: list) -> None:
        """Factors of one document's stretch; the stretch becomes part of the reference."""
        doc_id, text_hash, start, data = row
        factor = None                          # [place it continues, start, windows]
        for i in range(0, len(data), PIECE):
            window = data[i:i + PIECE]
            at = start + i // PIECE
            known = self.places.get(window)
            if known is None:
                self.places[window] = [doc_id, text_hash, at, False]
                source = None
            else:
                source = known
                if not known[3]:               # the earlier place repeats as well, which nobody told it yet
                    known[3] = True
                    out.append((known[0], known[1], known[2], 1, text_hash, at))
            if factor is not None and source is not None and source[1] == factor[0][1] and source[2] - factor[0][2] == at - factor[1]:
                factor[2] += 1
                continue
            if factor is not None:
                out.append((doc_id, text_hash, factor[1], factor[2], factor[0][1], factor[0][2]))
            factor = [source, at, 1] if source is not None else None
        if factor is not None:
            out.append((doc_id, text_hash, factor[1], factor[2], factor[0][1], factor[0][2]))


def parse_blocks(window: int, id_type: pa.DataType):
    """Rows sorted by seed -> factors. Blocks of a single row hold no repeat and are passed over."""
    names = ["doc_id", "text_hash", "start", "length", "source_hash", "source_start"]
    types = [id_type, pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]

    def made(out: list) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        columns[3] = [n + window - 1 for n in columns[3]]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, current, waiting = None, None, None       # waiting: the only row of ``current`` so far
        for batch in batches:
            is_seed = batch.column("windows").is_valid()
            spans = batch.filter(pc.invert(is_seed))
            if len(spans):
                yield pa.record_batch([spans.column("doc_id"), spans.column("text_hash"), spans.column("start"),
                                       spans.column("length"), spans.column("text_hash"), spans.column("start")], names=names)
            seeds = batch.filter(is_seed)
            if not len(seeds):
                continue
            keys = seeds.column("seed").to_numpy()
            edges = np.concatenate([_runs(keys[1:] == keys[:-1]), [len(keys)]])
            # only rows that share their seed, and the batch's first and last, are looked at
            wide = np.repeat(np.diff(edges) > 1, np.diff(edges))
            wide[[0, -1]] = True
            look = np.flatnonzero(wide)
            part = seeds.take(pa.array(look))
            out: list = []
            rows = zip(keys[look].tolist(), part.column("doc_id").to_pylist(), part.column("text_hash").to_pylist(),
                       part.column("start").to_pylist(), part.column("windows").to_pylist(), strict=True)
            for key, *row in rows:
                if key != current:
                    block, current, waiting = None, key, row
                    continue
                if block is None:
                    block = _Block(window)
                    block.parse(waiting, out)
                block.parse(row, out)
                if len(out) >= 100_000:
                    yield made(out)
                    out = []
            if out:
                yield made(out)
    return run


def routed(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows that the blocks get, by their key ``seed``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return named(docs, text=F.col("text")).mapInArrow(route(window, hot_cells(docs, window)), ROUTED.format(id=id_type))


def factors(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, start, length, source_hash, source_start): the parse's long factors. Every
    window that occurs elsewhere lies in one of its document's factors."""
    id_type = docs.schema["doc_id"].dataType
    blocks = routed(docs, window).repartition("seed").sortWithinPartitions("seed")
    return blocks.mapInArrow(parse_blocks(window, to_arrow_type(id_type)), FACTORS.format(id=id_type.simpleString()))


def _kept(words: list[bytes], spans: list | None) -> tuple[int, bytes]:
    if not spans:
        return 0, b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    start = np.array([s["start"] for s in spans])
    np.add.at(gone, start, 1)
    np.add.at(gone, start + np.array([s["length"] for s in spans]), -1)
    keep = np.cumsum(gone[:-1]) == 0
    return int(len(words) - keep.sum()), b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k])


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, n_words, n_removed, kept): each document's words outside repeated windows,
    joined by one space."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    spans = factors(docs, window).groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "length")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, found in zip(batch.column("text"), batch.column("spans"), strict=True):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                removed, rest = _kept(words, found.as_py())
                n_words.append(len(words))
                n_removed.append(removed)
                kept.append(rest)
            yield pa.record_batch([batch.column("doc_id"), batch.column("text_hash"), pa.array(n_words, pa.int64()),
                                   pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                                  names=["doc_id", "text_hash", "n_words", "n_removed", "kept"])

    return join_docs(named(docs, text=F.col("text")), spans, "left").mapInArrow(
        run, f"doc_id {id_type}, text_hash long, n_words long, n_removed long, kept string")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
