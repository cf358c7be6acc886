"""The corpus pipeline: language, near copies, repeated passages, personal data, packing.

Each stage reads all that its predecessor kept, as Parquet in the shared
folder, and its decisions take effect. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import functools
import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import langid, nearcopies, packing, pii, suffixdedup
from tripmill.llm.common import Tables
from tripmill.llm.queries import pii_key, vocabulary

#: A document is rejected if the learned languages explain its words no better than random letters, in log odds.
LEAST_ODDS = 0.0
#: The tables of the stage that made a frame, for whoever writes it.
_OWNERS: "weakref.WeakKeyDictionary[DataFrame, Tables]" = weakref.WeakKeyDictionary()


def _owned(made: DataFrame, tables: Tables) -> DataFrame:
    """A stage's result, with the tables that it reads: they can go when it is written, and not before."""
    _OWNERS[made] = tables
    return made


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those in none of the learned languages."""
    found = langid.predict(docs, langid.fit(docs))
    return found.where((F.col("lang_pred") != "und") & (F.col("odds") >= LEAST_ODDS)).select(*[F.col(f"row.`{c}`") for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of copies."""
    tables = Tables(spark)
    return _owned(nearcopies.keep_one(docs, tables=tables).select(*docs.columns), tables)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes later copies of strings of 200 bytes; documents of which nothing is left go."""
    tables = Tables(spark)
    found = suffixdedup.dedup(docs, keep_first=True, outputs=True, row=True, tables=tables)
    cut = F.col("n_removed") > 0
    text = F.when(cut, F.trim("kept")).otherwise(F.col("kept"))
    made = {"text": text, "n_chars": F.when(cut, F.length(text).cast("long")).otherwise(F.col("row.n_chars"))}
    left = found.where(~cut | (F.length(text) > 0)).select(*[made.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
    return _owned(left, tables)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by pseudonyms of the same format and length."""
    return pii.pseudonymize(docs, pii_key(spark)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 4096 ids."""
    tables = Tables(spark)
    return _owned(packing.pack(docs, vocabulary(), tables=tables), tables)


STAGES = [("language", language), ("near copies", near_copies), ("repeated passages", repeated_passages), ("private data", private_data), ("packing", packed)]

#: SQL expresses none of near copies by similarity, suffix arrays and BPE;
#: the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; what is between them is deleted once it is not read any more."""
    between = Tables(spark)

    def step(docs: DataFrame, stage: tuple) -> DataFrame:
        made = stage[1](spark, docs, sf_dir)
        written = between.write(made, "pipeline")
        if made in _OWNERS:
            _OWNERS.pop(made).sweep()
        between.drop(docs)
        return written

    return functools.reduce(step, STAGES, spark.read.parquet(f"{sf_dir}/documents.parquet"))
