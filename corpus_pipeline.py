"""A training corpus from raw documents, in five stages.

Each stage works on all rows that the one before it kept, and its result is written and
read again before the next one. ``run`` is the whole of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorline.llm import jaccard, language, mixing, packing, toxicity
from tremorline.llm.common import held_out, table, written
from tremorline.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Share of the best profile's order that a text must show to be in its language.
LEAST_LANGUAGE_SCORE = 0.05


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; ``lang`` becomes what was recognised.
    Rejected are texts without letters and texts that fit no language's profile."""
    found = language.identify(docs)
    kept = found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return kept.withColumn("lang", F.col("lang_pred")).select(COLUMNS)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a toxic window. The network learns from the labels of documents
    that are still there."""
    labels = table(spark, sf_dir, "labels")
    network = toxicity.fit(docs.withColumn("held_out", held_out("doc_id", 4, 2)), labels)
    return toxicity.with_score(docs, network).where("predicted = 0").select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies. Of rows that
    repeat that id and its text one stays, rows of that id with another text stay too; rows
    without an id are in no group and stay."""
    groups = jaccard.link(docs).where("doc_id = component_id").select(F.col("doc_id").alias("kept")).distinct()
    first = docs.join(groups, F.col("doc_id") == F.col("kept"), "left_semi").dropDuplicates(["doc_id", "text"])
    return first.select(COLUMNS).union(docs.where("doc_id is null").select(COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequence: documents as often as the mix takes them, by position."""
    return mixing.arrange(docs, mixing.mix(docs)).select(COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces of the sequence of documents, with their places in packed sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language", identify_language),
    ("toxicity", reject_toxic),
    ("near copies", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Trained models and hashes decide the rows. The tests compare the near-copy stage with a
#: brute-force version; of the whole run they check the number of rows and their ids only.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    name, stage = STAGES[-1]
    return stage(spark, docs, sf_dir)
