"""Case / control / other labelling.

The original labelling is a cascade of per-set RDD subtract/intersection
steps, each a shuffle.  Here every patient gets **one flag row** from a single
aggregation over the union of the three event tables:

    dx ∪ med ∪ lab  →  per-event flags  →  groupBy(patient_id)  →  CASE WHEN

That is one shuffle on ``patient_id`` for the whole cohort.  The partial
(map-side) aggregate collapses each task's rows to one row per patient before
the shuffle, so a patient holding a third of all events costs the final
aggregate only one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import abnormal_lab, contains_text, in_code_set, in_set_or_prefix
from ..session import broadcast_if_small
from ..sources.criteria import Profile, get_profile
from .setops import bag_union, difference, intersection

CASE, CONTROL, OTHER = 1, 2, 3

_FLAG_COLUMNS = (
    "t1_dx", "t2_dx", "dm_related_dx", "t1_med", "t2_med", "glucose_test", "abnormal_lab",
)


def _event_rows(dx: DataFrame, med: DataFrame, lab: DataFrame, p: Profile) -> DataFrame:
    no = F.lit(False)
    no_ts = F.lit(None).cast("timestamp")

    def row(pid, t1_dx=no, t2_dx=no, dm=no, t1_med=no, t2_med=no, t1_ts=no_ts, t2_ts=no_ts,
            glucose=no, abnormal=no):
        return [
            pid, t1_dx.alias("t1_dx"), t2_dx.alias("t2_dx"), dm.alias("dm_related_dx"),
            t1_med.alias("t1_med"), t2_med.alias("t2_med"), t1_ts.alias("t1_ts"),
            t2_ts.alias("t2_ts"), glucose.alias("glucose_test"), abnormal.alias("abnormal_lab"),
        ]

    code, drug = F.col("code"), F.col("medicine")
    is_t1_med, is_t2_med = in_code_set(drug, p.t1dm_med), in_code_set(drug, p.t2dm_med)
    dx_rows = dx.select(*row(
        "patient_id",
        t1_dx=in_code_set(code, p.t1dm_dx),
        t2_dx=in_code_set(code, p.t2dm_dx),
        dm=in_set_or_prefix(code, p.dm_related_dx, p.dm_related_prefixes),
    ))
    med_rows = med.select(*row(
        "patient_id",
        t1_med=is_t1_med,
        t2_med=is_t2_med,
        t1_ts=F.when(is_t1_med, F.col("ts")),
        t2_ts=F.when(is_t2_med, F.col("ts")),
    ))
    lab_rows = lab.select(*row(
        "patient_id",
        glucose=contains_text("test_name"),
        abnormal=abnormal_lab("test_name", "value"),
    ))
    return bag_union(dx_rows, med_rows, lab_rows)


def patient_flags(dx: DataFrame, med: DataFrame, lab: DataFrame,
                  profile: str | Profile = "reference") -> DataFrame:
    """C1-C10 as one row per patient of the spine.

    Columns: ``patient_id``, the boolean flags ``t1_dx t2_dx dm_related_dx
    t1_med t2_med glucose_test abnormal_lab`` and the first-order instants
    ``first_t1_med first_t2_med`` (A4).  Presence of a drug is its own flag, not
    inferred from a non-null date.
    """
    p = get_profile(profile)
    events = _event_rows(dx, med, lab, p)
    aggs = [F.bool_or(c).alias(c) for c in _FLAG_COLUMNS]
    aggs += [F.min("t1_ts").alias("first_t1_med"), F.min("t2_ts").alias("first_t2_med")]
    return events.groupBy("patient_id").agg(*aggs)


def case_path_columns(flags: DataFrame) -> DataFrame:
    """C2-C5 as boolean columns over a flag table."""
    t2_base = F.col("t2_dx") & ~F.col("t1_dx")
    path1 = t2_base & ~F.col("t1_med")
    path2 = t2_base & F.col("t1_med") & ~F.col("t2_med")
    # ties count as cases: first T1DM order at or after the first T2DM order
    path3 = (
        t2_base & F.col("t1_med") & F.col("t2_med")
        & (F.col("first_t1_med") >= F.col("first_t2_med"))
    )
    return flags.select(
        "*",
        t2_base.alias("t2dm_base"),
        path1.alias("case_path_1"),
        path2.alias("case_path_2"),
        F.coalesce(path3, F.lit(False)).alias("case_path_3"),
    )


def label_column(profile: str | Profile = "reference"):
    """``1`` case, ``2`` control, ``3`` other.

    A patient who is both case and control (possible only through a sentinel
    T2DM code outside the ``250`` prefix) is labelled case: one row per patient.
    """
    p = get_profile(profile)
    t2_base = F.col("t2_dx") & ~F.col("t1_dx")
    is_case = t2_base & (
        ~F.col("t1_med") | ~F.col("t2_med")
        | F.coalesce(F.col("first_t1_med") >= F.col("first_t2_med"), F.lit(False))
    )
    is_control = F.col("glucose_test") & ~F.col("dm_related_dx")
    if p.exclude_abnormal_from_controls:
        is_control = is_control & ~F.col("abnormal_lab")
    return (
        F.when(is_case, F.lit(CASE)).when(is_control, F.lit(CONTROL)).otherwise(F.lit(OTHER))
    )


def phenotype_labels(dx: DataFrame, med: DataFrame, lab: DataFrame,
                     profile: str | Profile = "reference") -> DataFrame:
    """``(patient_id, label)`` for every patient with any event."""
    flags = patient_flags(dx, med, lab, profile)
    return flags.select("patient_id", label_column(profile).alias("label"))


def patient_spine(dx: DataFrame, med: DataFrame, lab: DataFrame) -> DataFrame:
    """Distinct patient ids over the three event tables (U1 + U4)."""
    return bag_union(
        dx.select("patient_id"), med.select("patient_id"), lab.select("patient_id")
    ).distinct()


def first_drug_orders(med: DataFrame, profile: str | Profile = "reference") -> DataFrame:
    """A4 + J2: first T1DM and first T2DM order instant per patient having both.

    One conditional aggregate replaces two filtered scans and their join.
    """
    p = get_profile(profile)
    is_t1 = in_code_set("medicine", p.t1dm_med)
    is_t2 = in_code_set("medicine", p.t2dm_med)
    agg = med.where(is_t1 | is_t2).groupBy("patient_id").agg(
        F.bool_or(is_t1).alias("_t1"),
        F.bool_or(is_t2).alias("_t2"),
        F.min(F.when(is_t1, F.col("ts"))).alias("first_t1_med"),
        F.min(F.when(is_t2, F.col("ts"))).alias("first_t2_med"),
    )
    return agg.where("_t1 AND _t2").select("patient_id", "first_t1_med", "first_t2_med")


def patients_without_t1_dx(dx: DataFrame, med: DataFrame, lab: DataFrame,
                           profile: str | Profile = "reference") -> DataFrame:
    """U2 as the original first step: spine − patients with a T1DM diagnosis."""
    p = get_profile(profile)
    t1 = dx.where(in_code_set("code", p.t1dm_dx)).select("patient_id")
    return difference(patient_spine(dx, med, lab), t1, ["patient_id"])


def patients_with_both_drugs(med: DataFrame, profile: str | Profile = "reference") -> DataFrame:
    """Patients with a T1DM order ∩ patients with a T2DM order."""
    p = get_profile(profile)
    t1 = med.where(in_code_set("medicine", p.t1dm_med)).select("patient_id")
    t2 = med.where(in_code_set("medicine", p.t2dm_med)).select("patient_id")
    return intersection(t1, t2, ["patient_id"])


def glucose_tested(lab: DataFrame) -> DataFrame:
    """Patients with a glucose test."""
    return lab.where(contains_text("test_name")).select("patient_id").distinct()


def abnormal_lab_patients(lab: DataFrame, rules: DataFrame) -> DataFrame:
    """C8 through the P12 rule table: ``lab ⋈ rules`` on the test name, then the
    rule's comparison.  The default rule table has seven fixed rows; a table
    passed in is broadcast only after its size is checked."""
    j = lab.join(broadcast_if_small(rules), "test_name", "inner")
    hit = (
        ((F.col("op") == ">=") & (F.col("value") >= F.col("threshold")))
        | ((F.col("op") == ">") & (F.col("value") > F.col("threshold")))
        | ((F.col("op") == "<=") & (F.col("value") <= F.col("threshold")))
        | ((F.col("op") == "<") & (F.col("value") < F.col("threshold")))
        | ((F.col("op") == "=") & (F.col("value") == F.col("threshold")))
    )
    return j.where(hit).select("patient_id").distinct()


def dx_prefix_patients(dx: DataFrame, prefix: str = "250") -> DataFrame:
    """P10: patients with a diagnosis code starting with ``prefix``."""
    return (
        dx.where(F.substring("code", 1, len(prefix)) == prefix).select("patient_id").distinct()
    )


def code_set_members(dx: DataFrame, med: DataFrame, criteria: DataFrame) -> DataFrame:
    """S5 + P9 + P10: distinct ``(set_name, patient_id)`` for every code set a
    patient's events match, through the criteria dimension.

    One scan of the events and one equi-join: each event name carries its lookup
    keys, the whole name (for ``exact`` terms) and its leading characters up to
    the longest prefix term, so no non-equi join is needed.  Names repeat, so
    ``(patient, name)`` is made distinct first (a partial aggregate per task); the
    dimension is small and broadcast after a size check.
    """
    longest = criteria.where(F.col("match_kind") == "prefix").agg(F.max(F.length("term"))).first()[0] or 0
    events = bag_union(
        dx.select("patient_id", F.lit("dx").alias("source"), F.col("code").alias("name")),
        med.select("patient_id", F.lit("med").alias("source"), F.col("medicine").alias("name")),
    ).distinct()
    keys = [F.struct(F.lit("exact").alias("kind"), F.col("name").alias("key"))]
    keys += [
        F.struct(F.lit("prefix").alias("kind"), F.substring("name", 1, n).alias("key"))
        for n in range(1, longest + 1)
    ]
    keyed = events.select("patient_id", "source", F.explode(F.array(*keys)).alias("k")).select(
        "patient_id", "source", F.col("k.kind").alias("match_kind"), F.col("k.key").alias("term")
    )
    crit = broadcast_if_small(criteria.select("set_name", "source", "match_kind", "term"))
    return keyed.join(crit, ["source", "match_kind", "term"], "inner").select(
        "set_name", "patient_id"
    ).distinct()
