"""From raw documents to packed training sequences, one operator after the other.

``STAGES`` names the stages in order. Each takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of ``documents``. A stage works on everything that
the one before has kept, and everything it drops is gone:

1. toxicity: documents that the classifier rejects are dropped;
2. line dedup: of equal and nearly equal lines the first stays; documents that lose all their words are dropped;
3. near dedup: one document of each group of near-duplicates stays;
4. mix: sources are mixed to their target weights; documents come as often as the mix takes them, some not at all;
5. pack: the tokens of the mix are packed into sequences.

A null text is scored like an empty one, has no lines and no words, and takes no part in the mix; a null source is a source of its own. Rows equal in
id and text are one document to the line and near dedup. An empty table gives no pieces. Further columns of ``documents``, whatever their
names, are carried to the last stage; ``n_chars`` is brought up to date if it is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import line_dedup, minhash, mixing, packing, queries, toxicity
from kindred.session import staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, queries.read(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.without_toxic(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = line_dedup.without_repeated_lines(docs)
    if "n_chars" not in docs.columns:
        return left
    return left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.without_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

# A classifier and a tokenizer take part: SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``; every stage's result is a table in the scratch folder."""
    queries.reach_workers(spark)
    docs = queries.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
