"""Secret scan with multipart credential linking.

Strong parts (access ids, named assignments) and weak ones (bare key-like tokens, service addresses) are found
per text. Parts are then joined by interval within their scope, a block of lines between blank lines: a weak
part is reported only if a complementary part lies within ``REACH`` characters of it: a key next to an access
id or an address, an address next to an access id or a secret. An address does not complete itself: what stands
inside one completes no address. A key inside one is a part only as its userinfo, which the address completes, or as a
query value, which takes an access id; a path is no key.

Defined results: null and empty texts have no spans. Rows equal in id and text get equal spans. Other columns
are ignored. Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import join_docs, named, saved, table

REACH = 400                    # code points between parts of one credential
# The contract's patterns, in the order in which kinds are listed, and their least lengths.
BASE = [
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]
# weak parts: tokens of key length, however long, that mix letters and digits, also right after NAME=, and addresses of services
KEY = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"\b(?:https?|jdbc|mongodb|redis|amqp|postgres(?:ql)?|mysql|s3)://[^\s\"'<>]+")
KINDS = ["assign", "access", "hex", "key", "endpoint"]
# what a part counts as in a link: its kind, or for parts inside an address one of these
INSIDE_ASSIGN, INSIDE_ACCESS, USERINFO_KEY, QUERY_KEY = range(len(KINDS), len(KINDS) + 4)
SCOPE_END = re.compile(r"\n[\x20\t\r]*\n")
# link kind -> the link kinds that complete it
COMPLEMENTS = {3: [1, INSIDE_ACCESS, 4], 4: [0, 1, 3], USERINFO_KEY: [4], QUERY_KEY: [1, INSIDE_ACCESS]}
_KEYWORD = re.compile(r"(?i:password|passwd|secret|token|api_?key)", re.A)
_LONG_HEX = re.compile(r"[0-9a-f]{24}")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the contract's kinds, in order."""
    found = []
    for kind, (name, pattern, group, least) in enumerate(BASE):
        # a run of hex digits of the least length holds every match that does not fail
        if name == "hex" and not _LONG_HEX.search(text) or name == "access" and "AKIA" not in text \
                or name == "assign" and not _KEYWORD.search(text):
            continue
        scan = re.compile(r"[0-9a-f]{24,}") if name == "hex" else pattern
        found += [(m.start(), kind, m.end()) for m in scan.finditer(text) if m.end(group) - m.start(group) >= least]
    return sorted(found)


def weak_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, link kind) of candidates for the linked kinds, which are not reported on their own."""
    places = [m.span() for m in ENDPOINT.finditer(text)] if "://" in text else []
    found = [(start, 4, end, 4) for start, end in places]
    for m in KEY.finditer(text):
        if not (re.search(r"[0-9]", m[0]) and re.search(r"[A-Za-z]", m[0])):
            continue
        around = _around(places, m.start(), m.end())
        link = 3 if around is None else _in_address(text, *around, m.start(), m.end())
        if link is not None:
            found.append((m.start(), 3, m.end(), link))
    return found


def _around(places: list[tuple[int, int]], start: int, end: int) -> tuple[int, int] | None:
    """The address that a span overlaps."""
    at = bisect_right(places, (end - 1, len(KINDS) << 60)) - 1
    return places[at] if at >= 0 and places[at][1] > start else None


def _in_address(text: str, start: int, end: int, key_start: int, key_end: int) -> int | None:
    """What a key counts as that overlaps the address ``start`` to ``end``; None for a part of a path or host."""
    if key_start < start or key_end > end:
        return None
    rest = text.index("://", start) + 3
    tail = re.compile(r"[/?#]").search(text, rest, end)
    authority_end = tail.start() if tail else end
    if "@" in text[rest:authority_end] and key_end <= text.rindex("@", rest, authority_end):
        return USERINFO_KEY
    query = text.find("?", rest, end)
    return QUERY_KEY if 0 <= query < key_start and text[key_start - 1] in "=&?" else None


def link_kind(places: list[tuple[int, int]], start: int, kind: int, end: int) -> int:
    """What a base part counts as: one inside an address completes no address."""
    if _around(places, start, end) is None:
        return kind
    return {0: INSIDE_ASSIGN, 1: INSIDE_ACCESS}.get(kind, kind)


def find_parts(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, base, weak): arrays of (scope, start, kind, end, link) per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = pa.list_(pa.struct([(n, pa.int32()) for n in ("scope", "start", "kind", "end", "link")]))
        for batch in batches:
            base, weak = [], []
            for value in batch.column("text"):
                text = value.as_py() or ""
                strong, maybe = base_spans(text), weak_spans(text)
                # parts of a kind alone cannot complete each other
                ends = [m.start() for m in SCOPE_END.finditer(text)] if maybe else []
                places = [(s, e) for s, k, e, _ in maybe if k == 4]
                base.append([{"scope": _scope(ends, s), "start": s, "kind": k, "end": e, "link": link_kind(places, s, k, e)}
                             for s, k, e in strong])
                weak.append([{"scope": _scope(ends, s), "start": s, "kind": k, "end": e, "link": link} for s, k, e, link in maybe])
            yield pa.record_batch([batch.column("doc_id"), batch.column("text_hash"), pa.array(base, part), pa.array(weak, part)],
                                  names=["doc_id", "text_hash", "base", "weak"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    part = "array<struct<scope:int,start:int,kind:int,end:int,link:int>>"
    return named(docs, text=F.col("text")).mapInArrow(run, f"doc_id {kind}, text_hash long, base {part}, weak {part}")


def _scope(ends: list[int], at: int) -> int:
    return bisect_right(ends, at)


def link_parts(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """(doc_id, text_hash, linked): the weak parts that a complementary part completes. An interval join:
    parts meet in cells of ``reach`` code points within a scope, and each weak part looks into its own cell
    and the two next to it."""
    completes = F.lit(False)
    for weak, others in COMPLEMENTS.items():
        completes = completes | ((F.col("w.link") == weak) & F.col("o.link").isin(others))
    some = parts.filter(F.size("weak") > 0)
    cell = lambda c: F.floor(F.col(c) / reach)
    weak = (some.select("doc_id", "text_hash", F.explode("weak").alias("w")).select("doc_id", "text_hash", "w.*").distinct()
            .withColumn("cell", F.explode(F.array(*[cell("start") + d for d in (-1, 0, 1)]))))
    # of one kind in one cell only the first and last parts matter to a neighbour within reach
    other = (some.select("doc_id", "text_hash", F.explode(F.concat("base", "weak")).alias("o")).select("doc_id", "text_hash", "o.*")
             .withColumn("cell", cell("start")).groupBy("doc_id", "text_hash", "scope", "cell", "link")
             .agg(F.min("start").alias("low"), F.max("start").alias("high")))
    w = weak.alias("w")
    o = other.withColumnsRenamed({"doc_id": "other_id", "text_hash": "other_hash"}).alias("o")
    near = (F.abs(F.col("w.start") - F.col("o.low")) <= reach) | (F.abs(F.col("w.start") - F.col("o.high")) <= reach) \
        | F.col("w.start").between(F.col("o.low"), F.col("o.high"))
    met = w.join(o, F.col("w.doc_id").eqNullSafe(F.col("other_id")) & (F.col("w.text_hash") == F.col("other_hash"))
                 & (F.col("w.scope") == F.col("o.scope")) & (F.col("w.cell") == F.col("o.cell")) & completes & near)
    return (met.groupBy("w.doc_id", "w.text_hash")
            .agg(F.collect_set(F.struct("w.start", "w.kind", "w.end")).alias("linked")))


def scan_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """(doc_id, text_hash, base, spans): arrays of (start, kind, end), base and all, in order."""
    parts = saved(find_parts(docs))
    bare = F.transform("base", lambda p: F.struct(p["start"].alias("start"), p["kind"].alias("kind"), p["end"].alias("end")))
    return join_docs(parts.select("doc_id", "text_hash", bare.alias("base")), link_parts(parts, reach), "left").select(
        "doc_id", "text_hash", "base", F.when(F.col("linked").isNull(), F.col("base"))
        .otherwise(F.array_sort(F.concat("base", "linked"))).alias("spans"))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*[F.lit(k) for k in KINDS])
    listed = lambda c: F.array_join(F.transform(c, lambda p: F.concat_ws(
        ":", F.get(names, p["kind"]), p["start"].cast("string"), p["end"].cast("string"))), ",")
    n = lambda k: F.size(F.filter("base", lambda p: p["kind"] == k)).cast("long")
    return scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))
