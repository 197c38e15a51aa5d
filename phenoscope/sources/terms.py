"""Term-set source (S4): one term per line, lower-cased, de-duplicated, not trimmed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_term_set(spark: SparkSession, path: str) -> DataFrame:
    """One-column frame ``term``.

    Spark's text source splits lines on LF, CRLF and a bare CR, so a file that
    separates terms with bare CRs yields one term per CR-separated piece.
    Blanks are kept (``'glucatrol '`` stays distinct from ``'glucatrol'``).
    """
    return spark.read.text(path).select(F.lower("value").alias("term")).distinct()


def write_term_set(df: DataFrame, column: str, path: str) -> None:
    """Write one term per line (used to stage term files derived from data)."""
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)
