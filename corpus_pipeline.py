"""The corpus pipeline: five stages over ``documents``, each a call of one operator.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written
as Parquet and reread as the next stage's input.  All but the last return the
columns of their input.  No stage can be told in SQL as a whole (trained language
model, SimHash), so there is no ``ORACLE_SQL``; tests/llm compares the stages' operators
with brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenoscope.llm.common import read_table, written
from phenoscope.llm.decontam import drop_contaminated
from phenoscope.llm.language import UND, fit_language_model, identify_language
from phenoscope.llm.lines import dedup_lines
from phenoscope.llm.mixing import mix
from phenoscope.llm.simhash import drop_near_duplicates


#: A language must have this share of a text's letters, less its doubt, for the text to stay.
MIN_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents of which no language holds at least half (no text, no letter,
    or a tangle of languages), and gives the others without a ``lang`` the predicted one."""
    model = fit_language_model(docs)
    found = identify_language(docs, model, names=("_phx_lang", "_phx_score", "_phx_spans"))
    kept = found.where((F.col("_phx_lang") != UND) & (F.col("_phx_score") >= MIN_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", "_phx_lang")).select(*[f"`{c}`" for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated passages of two or more lines; ``n_chars`` follows the text."""
    cut = dedup_lines(docs, names=("_phx_lines", "_phx_removed")).select(*[f"`{c}`" for c in docs.columns])
    if "n_chars" in cut.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates."""
    return drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that contain an item of ``benchmark``."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents to the target weights, with ``domain``, ``tokens``, ``epoch``."""
    return mix(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
