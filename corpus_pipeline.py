"""The corpus pipeline: language ID, near duplicates, substring dedup, mixing, piece encoding.

Each stage takes the session, the documents its predecessor kept and the data
folder, and returns documents; its output is written and read back before the
next stage. Null texts, empty tables and repeated rows pass through the stages
as their operators define. Stages hand on the columns of ``documents``; other
columns of their input do not take part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadline.llm import jaccard, language, mixture, pieces, substring
from threadline.llm.inputs import ship, table
from threadline.llm.queries import tokenizer_file
from threadline.plans.scratch import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a language; those the operator names none for (null, no letter) go."""
    ship(spark)
    model = language.train(docs)
    named = language.predict(docs.select(*COLUMNS), model, lang_pred="_lang_pred", score_col="_score")
    return named.where(F.col("_lang_pred") != language.UNKNOWN).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of linked documents, and documents linked with none."""
    ship(spark)
    return jaccard.keep_first(docs.select(*COLUMNS))


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes words in windows that a document with a smaller id has; other texts stay as they are."""
    ship(spark)
    done = substring.dedup(docs.select(*COLUMNS))
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    return done.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; documents it does not take go."""
    ship(spark)
    scratch = Scratch(spark, "mix")
    names = mixture.mix_rows(docs.select(*COLUMNS), scratch)
    return names.select(*COLUMNS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids of the pieces, and whether they decode to the text."""
    ship(spark)
    done = pieces.encode_and_decode(docs.select(*COLUMNS), tokenizer_file("piece_bpe_32k.model"))
    return done.select("doc_id", "source", "n_chars", "pieces", F.col("decoded").eqNullSafe(F.col("text")).alias("same"))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("substrings", remove_repeats),
    ("mixture", mix_sources),
    ("pieces", encode_pieces),
]
#: SQL has no form of the classifier or the encoder; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs
