"""A corpus pipeline over ``documents``: five stages, each one operator of ``partweave.llm``.

Every stage takes ``(spark, docs, sf_dir)``; what it returns is written as
Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``documents``. Null and repeated rows follow the operators' docstrings;
an empty table passes through as an empty table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partweave.llm.langid import UNDETERMINED, fit_languages, identify_languages
from partweave.llm.line_dedup import drop_repeated_lines
from partweave.llm.mixing import mix_sources
from partweave.llm.near_dup import drop_near_duplicates
from partweave.llm.packing import pack_documents
from partweave.llm.queries import vocabulary
from partweave.session import stage_alone

#: Below it too few n-grams belong to any one language. Clean prose scores above 0.5.
LEAST_SCORE = 0.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; ``lang`` stays as it came.
    Goes: null texts, texts without a letter, texts in no known language."""
    model = fit_languages(docs, F.lit(True))
    read = identify_languages(docs, model, pred_col="pipeline_lang", score_col="pipeline_score")
    pred, score = read.columns[-2:]
    return read.where((F.col(pred) != UNDETERMINED) & (F.col(score) >= LEAST_SCORE)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that repeat earlier ones; a document with no line of its own goes."""
    out = drop_repeated_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id."""
    return drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, those of small sources as often as their target weight asks for."""
    out, _ = mix_sources(docs)
    return out.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document in sequences of at most 4096 tokens."""
    return pack_documents(docs, vocabulary())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mix),
    ("packing", pack),
]

#: Language ID, MinHash signatures and the tokenizer have no SQL form; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. What a stage staged on its way goes once its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage_alone(spark, lambda step=step, docs=docs: step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
