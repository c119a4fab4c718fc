"""A corpus pipeline: language identification, near-duplicate removal, decontamination, source mixing, token store.

Each stage gets the documents that the one before kept, and all but the last return the columns of `documents`.

Defined results: each row is judged by its own text, whatever its doc_id (stage 2 keeps one row of those that repeat a
kept document); rows without a letter go in stage 1, and with them null and empty texts; a null doc_id stays unless its
text is rejected, and is drawn as one document in stage 4; null language or source counts as a value of its own there;
texts are whole, however long; ties follow the operators; an empty table gives an empty result; other columns are kept,
whatever their names, up to stage 4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rasterloom.llm import decontam, langid, mixing, neardup, scratch, store

STAGES = [
    ("language_id", langid.identified),
    ("near_dedup", neardup.deduplicated),
    ("decontamination", decontam.clean),
    ("mixing", mixing.mixed),
    ("token_store", store.stored),
]

#: The language model of the first stage has no SQL form; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents; each result is written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        with scratch.swept(spark) as keep:  # what the stage itself wrote goes once its result is there
            docs, path = scratch.written(stage(spark, docs, sf_dir), f"stage{k}-{name}")
            keep(path)
    return docs
