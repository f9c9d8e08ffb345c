"""Quality rules: every rule is evaluated once into a ledger of failure bits and measurements;
versioned policies and ablations are then bit arithmetic on the ledger.

Defined results: null and empty texts have no words and zero measurements, and fail the rule on too few
words. A ratio over nothing is 0. Repeated rows get equal ledgers; other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import WHITESPACE, let, plain_words, saved, table

WINDOW = 8


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words that stand in a ``width``-word window found twice or more in the text.

    Windows are compared by a 64-bit hash of their words' hashes. Most texts repeat none, which a
    distinct count shows; only the others sort their (hash, position) pairs and add up what the
    repeated windows cover.
    """
    last = F.size(words) - width

    def covered(windows: Column) -> Column:
        pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = lambda s, i, j: F.get(s, j)["h"] == F.get(s, i)["h"]
        starts = let(pairs, lambda s: F.sort_array(F.transform(
            F.filter(F.transform(s, lambda e, i: F.struct(e["i"].alias("i"), (
                F.coalesce(same(s, i, i - 1), F.lit(False)) | F.coalesce(same(s, i, i + 1), F.lit(False))).alias("twice"))),
                lambda e: e["twice"]), lambda e: e["i"])))
        # each start covers up to the next start, at most one window
        return let(starts, lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(width), F.coalesce(F.get(p, i + 1) - x, F.lit(width)))),
            F.lit(0), lambda total, x: total + x))

    def of_hashes(hashes: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), last),
                              lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(width)]))
        return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w)))

    return F.when(last < 1, F.lit(0)).otherwise(
        let(F.transform(words, lambda x: F.xxhash64(x)), of_hashes)).cast("long")


def measurements(docs: DataFrame) -> DataFrame:
    """``docs`` with the measurements every rule reads, each computed once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, WHITESPACE, "") != "")
    measured = docs.withColumns({"words": plain_words(F.col("text")), "word_lines": lines})
    return measured.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
        "n_lines": F.size("word_lines").cast("long"),
        "n_dup_lines": (F.size("word_lines") - F.size(F.array_distinct("word_lines"))).cast("long"),
        "n_repeat_words": repeated_words(F.col("words")),
        "n_upper": (F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long"),
    }).drop("words", "word_lines")


@dataclass(frozen=True)
class Rule:
    """A rule's bit in the ledger, its name and when a document fails it."""

    bit: int
    name: str
    fails: Callable[[], Column]
    sql: str


# The bits are fixed once given; a changed rule gets a new bit, so that old ledgers stay readable.
RULES = [
    Rule(0, "few_words", lambda: F.col("n_words") < 20, "n_words < 20"),
    Rule(1, "repeated_windows", lambda: 100 * F.col("n_repeat_words") > 30 * F.col("n_words"),
         "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", lambda: 4 * F.col("n_symbols") > F.col("n_words"), "4 * n_symbols > n_words"),
    Rule(3, "duplicate_lines", lambda: 2 * F.col("n_dup_lines") > F.col("n_lines"), "2 * n_dup_lines > n_lines"),
    Rule(4, "capitals", lambda: 2 * F.col("n_upper") > F.col("word_chars"), "2 * n_upper > word_chars"),
    Rule(5, "short_words", lambda: F.col("word_chars") < 2 * F.col("n_words"), "word_chars < 2 * n_words"),
    Rule(6, "long_words", lambda: F.col("word_chars") > 20 * F.col("n_words"), "word_chars > 20 * n_words"),
]
BASE_MASK = 0b11                        # the contract's base rules
# policy version -> bits that reject; a document is rejected if it fails any of them
POLICIES = {1: BASE_MASK, 2: 0b0011111, 3: 0b1111111}
CURRENT_POLICY = 3


def ledger(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """``docs`` with the measurements and ``failed_bits``: every rule evaluated once."""
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(rule.fails(), F.lit(1 << rule.bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return measurements(docs).withColumn("failed_bits", bits)


def apply_policy(entries: DataFrame, mask: int) -> DataFrame:
    """``entries`` of the ledger with ``kept``: no bit of the policy's mask failed."""
    return entries.withColumn("kept", F.col("failed_bits").bitwiseAND(F.lit(mask)) == 0)


def ablation(entries: DataFrame, mask: int, rules: list[Rule] = RULES) -> DataFrame:
    """(rule, rejected, only_this, gained): documents each rule rejects, those no other rule of the
    policy rejects, and what the policy would keep without the rule. The ledger is first counted by its
    bits (at most 2^rules rows), so the documents are read once; ``entries`` may be counted already
    (failed_bits, n)."""
    counted = entries if "n" in entries.columns else entries.groupBy("failed_bits").agg(F.count("*").alias("n"))
    table = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit"))
                      for r in rules if mask >> r.bit & 1])
    per_rule = counted.select("n", F.col("failed_bits").bitwiseAND(F.lit(mask)).alias("bits"), F.explode(table).alias("r"))
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    alone = F.col("bits") == F.col("r.bit")
    kept = F.col("bits") == 0
    zero = F.lit(0)
    return per_rule.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(hit, F.col("n")).otherwise(zero)).alias("rejected"),
        F.sum(F.when(alone, F.col("n")).otherwise(zero)).alias("only_this"),
        F.sum(F.when(kept | alone, F.col("n")).otherwise(zero)).alias("kept_without"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return apply_policy(entries, POLICIES[CURRENT_POLICY]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("failed_bits").bitwiseAND(F.lit(BASE_MASK)) != 0).alias("base_failed"), "kept", "failed_bits",
        *[(F.col("failed_bits").bitwiseAND(F.lit(mask)) == 0).alias(f"kept_v{version}") for version, mask in POLICIES.items()])


def quality_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every policy version's ablation over the ledger of ``documents``."""
    entries = ledger(table(spark, sf_dir, "documents").select("doc_id", "text")).groupBy("failed_bits").agg(F.count("*").alias("n"))
    counted = saved(entries)                       # at most 2^rules rows
    parts = [ablation(counted, mask).withColumn("policy", F.lit(version)) for version, mask in POLICIES.items()]
    return reduce(DataFrame.unionByName, parts)


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, i, array_to_string(words[i:i+7], ' ') AS win
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM d WHERE len(words) >= 8)),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM w),
p AS (SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS c FROM g WHERE n > 1),
r AS (SELECT doc_id, CAST(sum(c) AS BIGINT) AS n_repeat_words FROM p GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
m AS (SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
        CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words,
        length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS n_upper
        FROM d JOIN l ON d.doc_id = l.doc_id LEFT JOIN r ON d.doc_id = r.doc_id),
b AS (SELECT *, CAST(""" + " + ".join(f"CASE WHEN {r.sql} THEN {1 << r.bit} ELSE 0 END" for r in RULES) + """ AS BIGINT)
        AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed_bits & 3) <> 0 AS base_failed,
        (failed_bits & """ + str(POLICIES[CURRENT_POLICY]) + """) = 0 AS kept, failed_bits""" + "".join(
    f", (failed_bits & {mask}) = 0 AS kept_v{version}" for version, mask in POLICIES.items()) + """ FROM b
"""

ABLATION_ORACLE = "WITH q AS (" + ORACLE + ")" + " UNION ALL ".join(f"""
SELECT {version} AS policy, '{r.name}' AS rule, count(*) FILTER (failed_bits & {1 << r.bit} <> 0) AS rejected,
        count(*) FILTER (failed_bits & {mask} = {1 << r.bit}) AS only_this,
        count(*) FILTER (failed_bits & {mask & ~(1 << r.bit)} = 0) AS kept_without FROM q"""
                                                                       for version, mask in POLICIES.items() for r in RULES if mask >> r.bit & 1)
