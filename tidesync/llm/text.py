"""Column helpers shared by the text operators (built-in functions only)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITESPACE = " \t\n\x0b\x0c\r"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"     # after A-Z were lower-cased


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """Rows written to the shared checkpoint folder, so later jobs (and retries after a lost
    executor) read them instead of computing them again."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is. ``lower`` is used where the text has one
    byte per character, as it changes nothing else there."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


# Words are exploded with the outer form and filtered after: the plain form adds a filter on the array's size below,
# which would find the words twice.

def plain_words(text: Column) -> Column:
    r"""Words ``[^\x20\x09-\x0D]+`` of a text, in order; none for null."""
    spaced = reduce(lambda t, ch: F.replace(t, F.lit(ch), F.lit(" ")), WHITESPACE[1:], F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(spaced, " ", -1), "")


def folded_words(text: Column) -> Column:
    r"""Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the text with A-Z lower-cased; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD, -1), "")


def named(docs: DataFrame, **columns: Column) -> DataFrame:
    """(doc_id, text_hash, the given columns). (doc_id, text_hash) names a document where ids are null
    or repeated; rows equal in both are equal in every result."""
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), *[c.alias(n) for n, c in columns.items()])


def join_docs(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """``left`` joined to ``right`` on (doc_id, text_hash), null ids included; the keys come once."""
    other = right.withColumnsRenamed({"doc_id": "other_id", "text_hash": "other_hash"})
    same = F.col("doc_id").eqNullSafe(F.col("other_id")) & (F.col("text_hash") == F.col("other_hash"))
    return left.join(other, same, how).drop("other_id", "other_hash")


def literal_rows(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A small table of fixed parameters as literals of the plan."""
    structs = [F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row, strict=True)]) for row in rows]
    return spark.range(1).select(F.explode(F.array(*structs)).alias("row")).select("row.*")


def small_broadcast(kept: DataFrame, max_rows: int) -> DataFrame:
    """``kept`` (narrow rows, written before by ``saved``, so counting reads them only) with a broadcast hint if it has
    at most ``max_rows`` rows; beyond that the join shuffles."""
    return F.broadcast(kept) if kept.count() <= max_rows else kept


def checked_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` (narrow rows of a few numbers) with a broadcast hint if it has at most ``max_rows`` rows;
    beyond that the join shuffles."""
    return F.broadcast(df) if df.count() <= max_rows else df      # partial counts: no row is moved for them


def carried(docs: DataFrame, *needed: str) -> DataFrame:
    """The needed columns, and all others in one struct, where their names meet no name of an operator."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in needed]
    return docs.select(*needed, (F.struct(*rest) if rest else F.lit(None)).alias("carried_columns"))


def restored(df: DataFrame, columns: list[str], needed: list[str], added: list[str]) -> DataFrame:
    """The columns that ``carried`` took, in order, then the added ones, which replace columns of their name."""
    return df.select(*[F.col(c) if c in needed else F.col("carried_columns").getField(c).alias(c)
                       for c in columns if c not in added], *added)
