"""The documents of a corpus from raw rows to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.llm import language, mixing, packing, simhash, substrings
from flowgauge.llm.common import read, stored
from flowgauge.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be determined go: null texts and texts without a letter. The others stay as they are."""
    model = language.train(docs.filter(~language.held_out(F.col("doc_id"))))
    return language.identify(docs.select(*COLUMNS), model).filter(F.col("lang_pred") != language.UNDETERMINED).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one with the least id."""
    return simhash.keep_one(docs.select(*COLUMNS), shingle=4, distance=4)


def cut_repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the words of passages that stand earlier; the words kept are joined by one space."""
    return substrings.without_repeats(docs.select(*COLUMNS), window=20).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stands in the mix as often as it is taken: not at all, once or twice."""
    return mixing.mixed_rows(docs.select(*COLUMNS)).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with their token ids."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("substring dedup", cut_repeated_substrings),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # language identification and the random mix are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder. What a stage keeps is written as Parquet and read by the next."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
