"""Clustering quality against known classes.

purity = (1/N) Σ_k max_j |cluster_k ∩ class_j|
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def contingency(assignments: DataFrame, cluster: str = "cluster",
                label: str = "label") -> DataFrame:
    """``(cluster, label, n)`` counts; a partial aggregate per task first."""
    return assignments.groupBy(F.col(cluster).alias("cluster"), F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )


def purity(assignments: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    """A8 + A9 + M12: one row ``(n, purity)``.

    Every step after the contingency table works on at most
    ``clusters × classes`` rows.  An empty input gives ``n = 0`` and a NULL
    purity instead of an error.
    """
    per_cluster = contingency(assignments, cluster, label).groupBy("cluster").agg(
        F.max("n").alias("best"), F.sum("n").alias("total")
    )
    return per_cluster.agg(
        F.coalesce(F.sum("total"), F.lit(0)).cast("long").alias("n"),
        (F.sum("best") / F.sum("total")).alias("purity"),
    )


def assignments_with_labels(assignments: DataFrame, labels: DataFrame,
                            key: str = "patient_id") -> DataFrame:
    """Cluster assignments ⋈ phenotype labels on the patient; patients
    without features drop out (inner join).  Both sides are one row per
    patient, so this is a plain shuffle (or AQE broadcast) equi-join."""
    return assignments.join(labels, key, "inner")
