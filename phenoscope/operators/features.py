"""Feature tuples, the feature dictionary and patient vectors (A1-A5, A10, M1-M3).

Feature tuples are the long table ``(patient_id, feature, value)``: one row per
patient and distinct event name.  Counting and averaging are hash aggregates
with a partial (map-side) step, so a hot patient is pre-aggregated before the
shuffle.  Candidate restriction filters on a grouping key, so it is applied
*before* aggregation (same result as filtering after, less shuffle).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import broadcast_if_small, reliable_checkpoint, scratch_path
from .setops import bag_union

Candidates = Iterable[str] | DataFrame | None


def _restrict(events: DataFrame, column: str, candidates: Candidates) -> DataFrame:
    """Keep events whose name is a candidate term.

    A literal list becomes a hashed ``IN``; a term frame (for example one read
    by ``read_term_set``) becomes a left-semi join, broadcast only after its
    size is checked.
    """
    if candidates is None:
        return events
    if isinstance(candidates, DataFrame):
        terms = broadcast_if_small(candidates.select(F.col("term").alias("_term")).distinct())
        return events.join(terms, events[column] == terms["_term"], "left_semi")
    return events.where(F.col(column).isin(list(candidates)))


def _count_features(events: DataFrame, name: str) -> DataFrame:
    return events.groupBy("patient_id", F.col(name).alias("feature")).agg(
        F.count(F.lit(1)).cast("double").alias("value")
    )


def diagnostic_features(dx: DataFrame, candidates: Candidates = None) -> DataFrame:
    """A1 / A1f: diagnosis count per (patient, code), as double."""
    return _count_features(_restrict(dx, "code", candidates), "code")


def medication_features(med: DataFrame, candidates: Candidates = None) -> DataFrame:
    """A2 / A2f: medication order count per (patient, drug)."""
    return _count_features(_restrict(med, "medicine", candidates), "medicine")


def lab_features(lab: DataFrame, candidates: Candidates = None) -> DataFrame:
    """A3 / A3f: mean lab value per (patient, test); one ``avg`` replaces the
    sum ⋈ count of the original (J3, P17)."""
    return _restrict(lab, "test_name", candidates).groupBy(
        "patient_id", F.col("test_name").alias("feature")
    ).agg(F.avg("value").alias("value"))


def feature_tuples(dx: DataFrame, med: DataFrame, lab: DataFrame,
                   dx_candidates: Candidates = None, med_candidates: Candidates = None,
                   lab_candidates: Candidates = None, with_kind: bool = False) -> DataFrame:
    """M1 / M2: union of the three feature tuple tables (``with_kind``: and whether
    a tuple comes from ``dx``, ``med`` or ``lab``).

    Computed as one aggregation: the (filtered) events of the three kinds are
    unioned as ``(patient_id, feature, kind, value)`` and grouped once by
    ``(patient_id, feature, kind)``: counts for diagnoses and medications, the
    mean for labs.  One exchange instead of three, same shuffled bytes; a name
    used by two kinds stays two rows, as with separate aggregations.
    """
    no_value = F.lit(None).cast("double")
    events = bag_union(
        _restrict(dx, "code", dx_candidates).select(
            "patient_id", F.col("code").alias("feature"), F.lit("dx").alias("kind"),
            no_value.alias("value")),
        _restrict(lab, "test_name", lab_candidates).select(
            "patient_id", F.col("test_name").alias("feature"), F.lit("lab").alias("kind"),
            F.col("value")),
        _restrict(med, "medicine", med_candidates).select(
            "patient_id", F.col("medicine").alias("feature"), F.lit("med").alias("kind"),
            no_value.alias("value")),
    )
    agg = events.groupBy("patient_id", "feature", "kind").agg(
        F.count(F.lit(1)).cast("double").alias("_n"), F.avg("value").alias("_mean")
    )
    return agg.select(
        "patient_id", "feature", *(["kind"] if with_kind else []),
        F.when(F.col("kind") == "lab", F.col("_mean")).otherwise(F.col("_n")).alias("value"),
    )


def candidate_tuples(tuples: DataFrame, candidates: dict[str, Candidates]) -> DataFrame:
    """M2 from M1: the tuples (with their ``kind``) whose name is a candidate of its
    kind.  Candidates restrict grouping keys, so the aggregates need not be redone."""
    parts = [_restrict(tuples.where(F.col("kind") == kind), "feature", terms)
             for kind, terms in candidates.items()]
    return bag_union(*parts)


def dense_index(df: DataFrame, column: str, out: str = "idx") -> DataFrame:
    """A10 helper: distinct values of ``column`` with dense 0-based ids in
    ascending order, computed without a single-partition window.

    Distinct values are range-partitioned and sorted, then written to the
    shared checkpoint folder so partition boundaries are fixed (a recomputed
    range shuffle could draw other boundaries).  Each row's id is its position
    inside its partition plus the number of values in earlier partitions; the
    per-partition counts table has one row per partition.
    """
    names = reliable_checkpoint(
        df.select(column).distinct().repartitionByRange(column).sortWithinPartitions(column)
    )
    part = F.spark_partition_id()
    # monotonically_increasing_id = (partition << 33) + position in partition
    pos = names.select(
        column,
        part.alias("_part"),
        (F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)).alias("_local"),
    )
    counts = pos.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: a tiny frame, safe to order globally and broadcast
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return pos.join(F.broadcast(offsets), "_part").select(
        column, (F.col("_off") + F.col("_local")).alias(out)
    )


def feature_dictionary(tuples: DataFrame) -> DataFrame:
    """A10: ``(feature, idx)``, alphabetical dense ids.

    Alphabetical order makes ids deterministic (the original's order depended
    on ``collect`` order).
    """
    return dense_index(tuples, "feature", "idx")


def feature_matrix_long(tuples: DataFrame, dictionary: DataFrame) -> DataFrame:
    """J6 + M3 (long form): ``(patient_id, idx, value)``.

    The dictionary is bounded by the vocabulary, not by the data; it is
    broadcast after a size check and shuffle-joined beyond it.
    """
    d = broadcast_if_small(dictionary)
    return tuples.join(d, "feature", "inner").select("patient_id", "idx", "value")


def patient_entries(long: DataFrame) -> DataFrame:
    """A5: a patient's ``(idx, value)`` pairs, sorted by index.  The list is
    bounded by the vocabulary (tuples are already one row per feature)."""
    return long.groupBy("patient_id").agg(
        F.sort_array(F.collect_list(F.struct("idx", "value"))).alias("entries")
    )


def patient_vectors(long: DataFrame, size: int) -> DataFrame:
    """M3: ``(patient_id, features)`` with sparse ``VectorUDT`` features, one
    partition sorted by patient id.

    Grouping and sorting run in Spark, and no Python is involved: a sparse vector's
    columns (type 0, size, indices, values) are written as a plain struct to the
    shared folder and read back as vectors.  Every fitting pass reads that table.
    """
    idx = F.col("entries.idx")
    # The same feature name from two event types gives a patient one index
    # twice; fail in Spark instead of building an invalid vector
    e = patient_entries(long).where(
        F.when(F.size(F.array_distinct(idx)) != F.size(idx),
               F.raise_error(F.lit("duplicate feature index for a patient")))
        .otherwise(F.lit(True))
    )
    vector = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(size).cast("int").alias("size"),
                      idx.cast("array<int>").alias("indices"),
                      F.col("entries.value").cast("array<double>").alias("values"))
    path = scratch_path(long.sparkSession, "vectors")
    e.select("patient_id", vector.alias("features")).sortWithinPartitions("patient_id").write.parquet(path)
    id_field = e.schema["patient_id"]
    schema = T.StructType([id_field, T.StructField("features", VectorUDT())])
    return e.sparkSession.read.schema(schema).parquet(path)


def dense_patient_vectors(long: DataFrame, size: int) -> DataFrame:
    """M3, dense form, fully JVM-side: ``(patient_id, features)`` with dense
    vectors of width ``size`` (what the scaler works on anyway)."""
    return dense_vectors_from_entries(patient_entries(long), size)


def dense_vectors_from_entries(e: DataFrame, size: int) -> DataFrame:
    """Dense vectors from per-patient ``entries``: a projection, no shuffle."""
    m = F.map_from_entries(F.col("entries"))  # duplicate keys raise (D12)
    dense = F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)),
        lambda i: F.coalesce(F.try_element_at(m, i), F.lit(0.0)),
    )
    return e.select("patient_id", array_to_vector(dense).alias("features"))
