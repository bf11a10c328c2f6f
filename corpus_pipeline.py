"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs.  All but the last
return the columns of documents, and carry other columns of any name along.

Nulls and empty texts are documents like others: they show no sign of bad
quality, are no copies, hold no benchmark item or personal data, and have no
tokens.  Repeated rows are kept or dropped together, but for near duplicates,
where rows equal in id and text stay together.  Empty tables stay empty.
"""

from __future__ import annotations

from loomgraph.llm.bpe import encode
from loomgraph.llm.decontaminate import remove_leaking_rows
from loomgraph.llm.jaccard_join import keep_one
from loomgraph.llm.pii import redact
from loomgraph.llm.quality import keep_good
from loomgraph.shipping import ship
from loomgraph.storage import settle


def quality(spark, docs, sf_dir):
    """Drop the documents that importance resampling does not draw: noise and toxic ones."""
    return keep_good(docs, ship(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark, docs, sf_dir):
    """Keep one document of each component of similar ones."""
    ship(spark)
    return keep_one(docs)


def decontamination(spark, docs, sf_dir):
    """Drop the documents that hold a benchmark item."""
    return remove_leaking_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark, docs, sf_dir):
    """Replace personal data by its kind."""
    return redact(docs)


def token_ids(spark, docs, sf_dir):
    """doc_id, lang and source (where docs has them), n_tokens and ids of every document left."""
    ship(spark)
    return encode(docs).select("doc_id", *[c for c in ("lang", "source") if c in docs.columns], "n_tokens", "ids")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("personal_data", personal_data), ("token_ids", token_ids)]

# SQL expresses neither the trained stages nor BPE; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = settle(docs)
    return docs
