"""How Arrow-backed operators move packed columns between tasks.

Documents are dealt into *blocks* by a hash of id and text.  A block sends one
message to each *bucket* of a key range: its own distinct keys, sorted and
packed, so that a key however frequent counts once a block.  A bucket sees all
messages about its keys and may answer each block by a packed column aligned
with what the block sent.  Blocks and answers meet again in a cogroup, whose
text side is the same exchange, which Spark reuses.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Layout:
    """blocks of documents, buckets of keys, and the width of keys that need not be exact."""

    blocks: int
    buckets: int
    bits: int


def key_bits(tokens: int) -> int:
    """Bits of a hash that leave a chance of 2**-13 that a key equals another one by accident, at any size."""
    return min(64, max(32, tokens.bit_length() + 13))


def layout(docs: DataFrame, text: str = "text", block_chars: int = 4_000_000, bucket_words: int = 1_500_000) -> Layout:
    """Sizes in proportion to the corpus: a block holds about block_chars, a bucket the keys of bucket_words."""
    chars = docs.agg(F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("c")).first()["c"]
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tokens = chars // 6 + 1
    return Layout(max(partitions, chars // block_chars + 1), max(partitions, tokens // bucket_words + 1), key_bits(tokens))


def blocked(docs: DataFrame, blocks: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """block, doc_id, text; equal rows share a block, and null ids are spread by their texts."""
    return docs.select(F.pmod(F.xxhash64(id, text), F.lit(blocks)).cast("int").alias("block"), F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def row_key(id: str, text: str):
    """64 bits of a row's id and text: rows of one id, or of none, that differ in text have different keys."""
    return F.xxhash64(F.col(f"`{id}`"), F.col(f"`{text}`"))
