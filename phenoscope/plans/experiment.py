"""The whole experiment from raw files, as the original main program runs it:

    data_dir/lab_results_INPUT.csv  medication_orders_INPUT.csv
            encounter_INPUT.csv     encounter_dx_INPUT.csv
            med_filter.txt  lab_filter.txt  icd9_filter.txt   (optional)

→ typed events → labels → features (all, candidate) → scaler, PCA, three
clusterings → purity report.  Term files that are missing fall back to the
built-in candidate lists.

    python -m phenoscope DATA_DIR [--profile reference|published] [--on-error fail|drop]
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from ..operators import cohort
from ..session import path_exists, reliable_checkpoint
from ..sources.criteria import candidate_terms
from ..sources.csv import RAW_COLUMNS, read_csv_table
from ..sources.terms import read_term_set
from .context import Events
from .learn import ClusteringConfig, experiment_report, report_lines

TERM_FILES = {"med": "med_filter.txt", "lab": "lab_filter.txt", "dx": "icd9_filter.txt"}


def load_raw_events(spark: SparkSession, data_dir: str, on_error: str = "fail") -> Events:
    """S1-S3 + P1-P3: the four extracts as views named after their files."""
    raw = {
        stem: read_csv_table(spark, os.path.join(data_dir, f"{stem}.csv"), columns=cols)
        for stem, cols in RAW_COLUMNS.items()
    }
    return Events(raw, on_error)


def load_candidates(spark: SparkSession, data_dir: str) -> dict:
    """Term sets per kind, from the data folder when present."""
    out = {}
    for kind, name in TERM_FILES.items():
        path = os.path.join(data_dir, name)
        out[kind] = read_term_set(spark, path) if path_exists(spark, path) else \
            candidate_terms(kind)
    return out


def run(spark: SparkSession, data_dir: str, profile: str = "reference",
        on_error: str = "fail", cfg: ClusteringConfig = ClusteringConfig()
        ) -> tuple[DataFrame, DataFrame]:
    """Labels ``(patient_id, label)`` and the report ``(arm, algorithm, n, purity)``."""
    ev = load_raw_events(spark, data_dir, on_error)
    labels = reliable_checkpoint(cohort.phenotype_labels(ev.dx, ev.med, ev.lab, profile))
    cands = load_candidates(spark, data_dir)
    return labels, experiment_report(ev.dx, ev.med, ev.lab, labels, cfg, cands)


def main(argv=None) -> None:
    from ..session import build_session

    ap = argparse.ArgumentParser(prog="phenoscope")
    ap.add_argument("data_dir")
    ap.add_argument("--profile", default="reference", choices=["reference", "published"])
    ap.add_argument("--on-error", default="fail", choices=["fail", "drop"])
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    spark = build_session(args.master or os.environ.get("SPARK_MASTER", "local[*]"))
    labels, report = run(spark, args.data_dir, args.profile, args.on_error)
    for row in labels.groupBy("label").count().orderBy("label").collect():
        print(f"label {row['label']}: {row['count']} patients")
    for line in report_lines(report):
        print(line)
