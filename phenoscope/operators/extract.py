"""Raw extracts → typed event tables.

Output schemas (long, one row per event):

* diagnostic  ``(patient_id string, ts timestamp, code string)``
* lab_result  ``(patient_id string, ts timestamp, test_name string, value double)``
* medication  ``(patient_id string, ts timestamp, medicine string)``

Cleaning stays in Catalyst expressions (no row closures), so the scan, filter
and projection fuse into one codegen stage and the filter reaches the reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import (
    DEFAULT_INSTANT_PATTERN,
    lower_name,
    parse_instant,
    parse_number,
    present,
)


def _drop_nulls(df: DataFrame, on_error: str, cols) -> DataFrame:
    return df.dropna(subset=list(cols)) if on_error == "drop" else df


def extract_labs(raw: DataFrame, date_column: str = "Date_Collected",
                 pattern: str = DEFAULT_INSTANT_PATTERN, on_error: str = "fail",
                 drop_nan: bool = False) -> DataFrame:
    """P1 (P4-P7): lab results with a present value.

    ``date_column`` defaults to the collection date; ``drop_nan`` removes
    results whose text parses to NaN (kept by default).
    """
    out = raw.where(present("Numeric_Result")).select(
        F.col("Member_ID").alias("patient_id"),
        parse_instant(date_column, pattern, on_error).alias("ts"),
        lower_name("Result_Name", on_error, "test name").alias("test_name"),
        parse_number("Numeric_Result", on_error).alias("value"),
    )
    out = _drop_nulls(out, on_error, ("patient_id", "ts", "test_name", "value"))
    if drop_nan:
        out = out.where(~F.isnan("value"))
    return out


def extract_medications(raw: DataFrame, date_column: str = "Order_Date",
                        pattern: str = DEFAULT_INSTANT_PATTERN,
                        on_error: str = "fail") -> DataFrame:
    """P2 (P5, P7): medication orders."""
    out = raw.select(
        F.col("Member_ID").alias("patient_id"),
        parse_instant(date_column, pattern, on_error).alias("ts"),
        lower_name("Drug_Name", on_error, "drug name").alias("medicine"),
    )
    return _drop_nulls(out, on_error, ("patient_id", "ts", "medicine"))


def extract_diagnoses(encounters: DataFrame, encounter_dx: DataFrame,
                      pattern: str = DEFAULT_INSTANT_PATTERN,
                      on_error: str = "fail") -> DataFrame:
    """P3 + J1: encounters ⋈ encounter diagnoses on ``Encounter_ID``.

    Bag semantics: an encounter with several codes yields one row per code.
    Both sides are large at scale, so this is left to the planner (sort-merge,
    or broadcast when AQE sees a small side; AQE splits skewed encounter ids).
    """
    # each side is cleaned before the join: an encounter's instant is parsed
    # once (not once per code) and the join moves an 8-byte timestamp
    enc = encounters.select(
        "Encounter_ID",
        F.col("Member_ID").alias("patient_id"),
        parse_instant("Encounter_DateTime", pattern, on_error).alias("ts"),
    )
    dx = encounter_dx.select("Encounter_ID", lower_name("code", on_error, "code").alias("code"))
    out = enc.join(dx, "Encounter_ID", "inner").select("patient_id", "ts", "code")
    return _drop_nulls(out, on_error, ("patient_id", "ts", "code"))


def with_epoch_ms(df: DataFrame, ts: str = "ts", out: str = "ts_ms") -> DataFrame:
    """Replace an instant column by epoch milliseconds (P8), for zone-free output."""
    cols = [F.unix_millis(F.col(ts)).alias(out) if c == ts else F.col(c) for c in df.columns]
    return df.select(*cols)
