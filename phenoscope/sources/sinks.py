"""Label and feature sinks (S6, S7): tab-separated text like the original's
commented-out dumps, or Parquet (the default for anything read back by Spark).

Writes go to a folder the caller names; on a cluster that must be a shared
file system path (see ``session.scratch_path``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LABEL_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("label", T.IntegerType()),
])
FEATURE_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("feature", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


def write_labels(labels: DataFrame, path: str, fmt: str = "tsv") -> None:
    """``patient \\t label`` lines (``fmt='tsv'``) or Parquet."""
    _write(labels.select("patient_id", "label"), path, fmt)


def write_features(tuples: DataFrame, path: str, fmt: str = "tsv") -> None:
    """``patient \\t feature \\t value`` lines (``fmt='tsv'``) or Parquet."""
    _write(tuples.select("patient_id", "feature", "value"), path, fmt)


def read_labels(spark: SparkSession, path: str, fmt: str = "tsv") -> DataFrame:
    return _read(spark, path, fmt, LABEL_SCHEMA)


def read_features(spark: SparkSession, path: str, fmt: str = "tsv") -> DataFrame:
    return _read(spark, path, fmt, FEATURE_SCHEMA)


# names may hold commas (``glucose, serum``) and outer blanks, so nothing is quoted
# or trimmed; null and the empty text are marks of their own, which no name may be
NULL_TEXT, EMPTY_TEXT = "\\N", "\\E"
_TSV = {"sep": "\t", "quote": "\u0000", "escape": "\u0000", "nullValue": NULL_TEXT,
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _write(df: DataFrame, path: str, fmt: str) -> None:
    if fmt == "tsv":
        for f in df.schema.fields:
            if isinstance(f.dataType, T.StringType):
                bad = F.col(f.name).rlike("[\t\r\n\u0000]") | F.col(f.name).isin(NULL_TEXT, EMPTY_TEXT)
                message = F.concat(F.lit(f"{f.name} cannot be written as a tab-separated field: "), f.name)
                df = df.withColumn(f.name, F.when(bad, F.raise_error(message))
                                   .when(F.col(f.name) == "", EMPTY_TEXT).otherwise(F.col(f.name)))
        df.write.mode("overwrite").options(**_TSV).csv(path)
    elif fmt == "parquet":
        df.write.mode("overwrite").parquet(path)
    else:
        raise ValueError("fmt must be 'tsv' or 'parquet'")


def _read(spark: SparkSession, path: str, fmt: str, schema: T.StructType) -> DataFrame:
    if fmt == "tsv":
        df = spark.read.schema(schema).options(**_TSV).csv(path)
        return df.replace(EMPTY_TEXT, "")
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    raise ValueError("fmt must be 'tsv' or 'parquet'")
