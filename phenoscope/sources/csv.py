"""CSV extracts as named views."""

from __future__ import annotations

import functools
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the view name is the last run of word characters, ``.csv`` dropped.
_TABLE_NAME = re.compile(r"(\w+)(\.csv)?$")

# What an empty field is read as on its way to null; no extract holds it, so a quoted
# empty text stays one.
_NO_TEXT = "\u0000"

# The column that holds a malformed line while a file is read.
_REJECTED = "_rejected_line"

# Every raw extract column is text; nothing is inferred.
RAW_COLUMNS = {
    "lab_results_INPUT": ("Member_ID", "Date_Collected", "Result_Name", "Numeric_Result"),
    "medication_orders_INPUT": ("Member_ID", "Order_Date", "Drug_Name"),
    "encounter_INPUT": ("Encounter_ID", "Member_ID", "Encounter_DateTime"),
    "encounter_dx_INPUT": ("Encounter_ID", "code"),
}


def infer_table_name(path: str) -> str:
    """S3: ``data/x_INPUT.csv`` → ``x_INPUT``; ``a/b.txt`` → ``txt``; the path
    itself when nothing matches (``dir/``)."""
    m = _TABLE_NAME.search(path)
    return m.group(1) if m else path


def _first_line(spark: SparkSession, path: str) -> str:
    """The first line with text of a file, read through Hadoop as Spark's readers do."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    file = jvm.org.apache.hadoop.fs.Path(path)
    stream = file.getFileSystem(conf).open(file)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(file)
        stream = codec.createInputStream(stream) if codec else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine()
        while line is not None and not line.strip():
            line = reader.readLine()
        return (line or "").lstrip("\ufeff").rstrip("\r")
    finally:
        stream.close()


def files_by_header(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files under ``path`` grouped by their header line; files without any line
    are left out.  One line per file is read, several files at a time."""
    files = sorted(spark.read.format("text").load(path).inputFiles())
    with ThreadPoolExecutor(max_workers=16) as pool:
        headers = list(pool.map(lambda f: _first_line(spark, f), files))
    groups: dict[str, list[str]] = {}
    for file, header in zip(files, headers):
        if header:
            groups.setdefault(header, []).append(file)
    return groups


def _reader(spark: SparkSession, mode: str, delimiter: str):
    return (
        spark.read.option("header", "true").option("mode", mode).option("delimiter", delimiter)
        .option("inferSchema", "false")
        .option("enforceSchema", "false")
        .option("columnPruning", "false")
        .option("nullValue", _NO_TEXT)
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
    )


def read_csv_with_rejects(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                          mode: str = "DROPMALFORMED", delimiter: str = ",") -> tuple[DataFrame, DataFrame]:
    """A headed CSV extract as all-string columns, and its malformed rows as
    ``(file, line)``.

    Each file is read with its own header: files of one header are read together and
    the groups are united by name, so the files of a folder may order their columns
    differently and have further ones.  ``columns`` selects some by name; a file that
    lacks one is an error.  Without ``columns`` all columns of all files come, null where
    a file has none.

    Malformed rows (too few or too many fields) are judged on the whole row: with CSV
    column pruning a one-column read or a ``count()`` would keep rows that a full read
    drops, so this reader turns pruning off for itself.  Blanks are kept; an empty field
    is null, a quoted empty one is the empty text.
    """
    drop = mode.upper() == "DROPMALFORMED"
    rows, rejects = [], []
    for files in files_by_header(spark, path).values():
        names = _reader(spark, mode, delimiter).csv(files[0]).columns
        missing = [c for c in columns or () if c not in names]
        if missing:
            raise ValueError(f"{files[0]}: no column {', '.join(missing)} in {', '.join(names)}")
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, *[_REJECTED] * drop]])
        read = (_reader(spark, "PERMISSIVE" if drop else mode, delimiter)
                .option("columnNameOfCorruptRecord", _REJECTED).schema(schema).csv(files))
        if drop:
            # Spark refuses to read the rejected line alone, so each filter asks another column, too
            whole = F.coalesce(F.col(f"`{names[0]}`"), F.lit("")) >= ""
            rejects.append(read.where(F.col(_REJECTED).isNotNull() & whole)
                           .select(F.input_file_name().alias("file"), F.col(_REJECTED).alias("line")))
            read = read.where(F.col(_REJECTED).isNull() & whole)
        rows.append(read.select(*[f"`{c}`" for c in columns or names]))
    if not rows and columns is None:
        raise ValueError(f"{path}: no file with a header")
    if not rows:
        rows = [spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))]
    out = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=columns is None), rows)
    empty = spark.createDataFrame([], "file string, line string")
    return out, functools.reduce(DataFrame.unionByName, rejects, empty)


def read_csv_table(spark: SparkSession, path: str, table_name: str | None = None,
                   columns: Sequence[str] | None = None, mode: str = "DROPMALFORMED",
                   delimiter: str = ",") -> DataFrame:
    """S1 + S2: ``read_csv_with_rejects``, registered as a temp view (named after the path
    when ``table_name`` is omitted); its malformed rows are the view of that name with
    ``_rejected`` behind it."""
    name = table_name or infer_table_name(path)
    df, rejects = read_csv_with_rejects(spark, path, columns, mode, delimiter)
    df.createOrReplaceTempView(name)
    rejects.createOrReplaceTempView(f"{name}_rejected")
    return df


def write_csv_table(df: DataFrame, path: str, delimiter: str = ",", mode: str = "overwrite") -> None:
    """Write a frame as a headed CSV extract (used to stage raw extracts); ``append``
    adds files, which may have other columns.

    Blanks are kept, and an empty text (quoted) differs from a null (nothing)."""
    (df.write.mode(mode).option("header", "true").option("delimiter", delimiter)
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .option("emptyValue", '""').option("nullValue", "").csv(path))
