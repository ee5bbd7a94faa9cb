"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input.

    toxicity    documents predicted toxic go
    line_dedup  repeated lines go from the texts
    near_dedup  one document of each SimHash group stays
    mix         documents are repeated or left out toward the sources' target weights
    pack        what is left is tokenized and packed into sequences

Every stage but the last returns the columns of ``documents``.  Nulls, repeated
rows, empty tables and extra columns are treated as each operator's docstring
says; ``n_chars``, if there, follows the text that line dedup leaves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from priceframe.llm import line_dedup, mixing, packing, simhash_dedup, toxicity
from priceframe.llm.common import materialize, pick, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not predicted toxic, columns unchanged; learnt from ``labels`` and these documents.

    Without a toxic document to learn from, or with so few labels that no feature
    of a text has a weight, nothing is known to be toxic: all stay.
    """
    rows = materialize(toxicity.labelled(docs, table(spark, sf_dir, "labels")), "toxic-rows")
    if not rows.where("label = 1").head(1):
        return docs
    return toxicity.keep_clean(docs, toxicity.train(rows))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, later occurrences of a line cut from their texts."""
    out = line_dedup.line_dedup(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size("dropped") > 0, F.char_length("text").cast("long"))
                             .otherwise(pick("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*[pick(c) for c in docs.columns])


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash links."""
    return simhash_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    return mixing.mix(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids and places in the sequences."""
    return packing.pack(docs, with_ids=True)


STAGES = [("toxicity", drop_toxic), ("line_dedup", dedup_lines), ("near_dedup", dedup_documents),
          ("mix", mix_sources), ("pack", pack_documents)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


#: A trained classifier and a tokenizer are no SQL; tests/llm holds every stage against a plain version on small tables.
ORACLE_SQL = None
