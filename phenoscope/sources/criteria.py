"""Code sets, lab rules and candidate term lists.

Code sets are data: a small ``(set_name, match_kind, term)`` dimension with two
profiles.  ``reference`` reproduces what the original labelling code matches
(including its quirks: sentinel codes, a leading blank in one drug name, an
upper-case code that can never match lower-cased input, ``648`` instead of
``648.0``); ``published`` uses the criteria files as written (lower-cased,
de-duplicated).  Every list here is bounded and tiny, so it is always safe to
embed as an ``IN`` literal or to broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the original criteria for right results;
# they are listed as text, in their original order (duplicates included).
# ---------------------------------------------------------------------------

# reference profile: the sets the original labelling code actually uses
REFERENCE_T1DM_DX = (
    "code1", "250.01", "250.03", "250.11", "250.13", "250.21", "250.23", "250.31", "250.33",
    "250.41", "250.43", "250.51", "250.53", "250.61", "250.63", "250.71", "250.73", "250.81",
    "250.83", "250.91", "250.93",
)
REFERENCE_T2DM_DX = (
    "code2", "250.3", "250.32", "250.2", "250.22", "250.9", "250.92", "250.8", "250.82", "250.7",
    "250.72", "250.6", "250.62", "250.5", "250.52", "250.4", "250.42", "250.00", "250.02",
)
REFERENCE_T1DM_MED = (
    "med1", "lantus", " insulin glargine", "insulin aspart", "insulin detemir", "insulin lente",
    "insulin nph", "insulin reg", "insulin,ultralente", "insulin,ultralente",
)
REFERENCE_T2DM_MED = (
    "med2", "chlorpropamide", "diabinese", "diabanase", "diabinase", "glipizide", "glucotrol",
    "glucotrol xl", "glucatrol ", "glyburide", "micronase", "glynase", "diabetamide", "diabeta",
    "glimepiride", "amaryl", "repaglinide", "prandin", "nateglinide", "metformin",
    "rosiglitazone", "pioglitazone", "acarbose", "miglitol", "sitagliptin", "exenatide",
    "tolazamide", "acetohexamide", "troglitazone", "tolbutamide", "avandia", "actos", "actos",
    "glipizide",
)
REFERENCE_DM_RELATED_DX = (
    "790.21", "790.22", "790.2", "790.29", "648.81", "648.82", "648.83", "648.84", "648", "648",
    "648.01", "648.02", "648.03", "648.04", "791.5", "277.7", "V77.1", "256.4",
)

# published profile: the criteria files as written
PUBLISHED_T1DM_DX = (
    "250.01", "250.03", "250.11", "250.13", "250.21", "250.23", "250.31", "250.33", "250.41",
    "250.43", "250.51", "250.53", "250.61", "250.63", "250.71", "250.73", "250.81", "250.83",
    "250.91", "250.93",
)
PUBLISHED_T2DM_DX = (
    "250.3", "250.32", "250.2", "250.22", "250.9", "250.92", "250.8", "250.82", "250.7", "250.72",
    "250.6", "250.62", "250.5", "250.52", "250.4", "250.42", "250.00", "250.02",
)
PUBLISHED_T1DM_MED = (
    "lantus", "insulin glargine", "insulin aspart", "insulin detemir", "insulin lente",
    "insulin nph", "insulin reg", "insulin,ultralente",
)
PUBLISHED_T2DM_MED = (
    "chlorpropamide", "diabinese", "diabanase", "diabinase", "glipizide", "glucotrol",
    "glucotrol XL", "glucatrol ", "glyburide", "micronase", "glynase", "diabetamide", "diabeta",
    "glimepiride", "amaryl", "repaglinide", "prandin", "nateglinide", "metformin",
    "rosiglitazone", "pioglitazone", "acarbose", "miglitol", "sitagliptin", "exenatide",
    "tolazamide", "acetohexamide", "troglitazone", "tolbutamide", "avandia", "actos", "ACTOS",
    "glipizide",
)
PUBLISHED_DM_RELATED_DX = (
    "790.21", "790.22", "790.2", "790.29", "648.81", "648.82", "648.83", "648.84", "648.0",
    "648.00", "648.01", "648.02", "648.03", "648.04", "791.5", "277.7", "V77.1", "256.4",
)

# DM-related diagnoses also match every code whose first three characters are this
DM_RELATED_PREFIX = "250"

# abnormal lab rules, in order: (test name, comparison, threshold)
ABNORMAL_LAB_RULES = (
    ("hba1c", ">=", 6.0),
    ("hemoglobin a1c", ">=", 6.0),
    ("fasting glucose", ">=", 110.0),
    ("fasting blood glucose", ">=", 110.0),
    ("fasting plasma glucose", ">=", 110.0),
    ("glucose", ">", 110.0),
    ("glucose, serum", ">", 110.0),
)

# a lab test counts as a glucose test when its name contains this text
GLUCOSE_TEST_MARKER = "glucose"

# candidate term lists for the filtered feature arm, one term per line as shipped
CANDIDATE_MEDICATIONS = (
    "lantus", "insulin glargine", "insulin aspart", "insulin detemir", "insulin lente",
    "insulin nph", "insulin reg", "insulin,ultralente", "chlorpropamide", "diabinese",
    "diabanase", "diabinase", "glipizide", "glucotrol", "glucotrol XL", "glucatrol ", "glyburide",
    "micronase", "glynase", "diabetamide", "diabeta", "glimepiride", "amaryl", "repaglinide",
    "prandin", "nateglinide", "metformin", "rosiglitazone", "pioglitazone", "acarbose",
    "miglitol", "sitagliptin", "exenatide", "tolazamide", "acetohexamide", "troglitazone",
    "tolbutamide", "avandia", "actos", "ACTOS", "glipizide",
)
CANDIDATE_LABS = (
    "HbA1c", "Hemoglobin A1c", "Fasting Glucose", "Fasting blood glucose",
    "fasting plasma glucose", "Glucose", "glucose", "Glucose, Serum", "HbA1c", "Hemoglobin A1c",
    "Fasting Glucose", "Fasting blood glucose", "fasting plasma glucose", "Glucose", "glucose",
    "Glucose, Serum",
)
CANDIDATE_DIAGNOSES = (
    "790.21", "790.22", "790.2", "790.29", "648.81", "648.82", "648.83", "648.84", "648.0",
    "648.00", "648.01", "648.02", "648.03", "648.04", "791.5", "277.7", "V77.1", "256.4",
    "250", "250.0", "250.00", "250.01", "250.02", "250.03", "250.1", "250.10", "250.11", "250.12",
    "250.13", "250.2", "250.20", "250.21", "250.22", "250.23", "250.3", "250.30", "250.31",
    "250.32", "250.33", "250.4", "250.40", "250.41", "250.42", "250.43", "250.5", "250.50",
    "250.51", "250.52", "250.53", "250.6", "250.60", "250.61", "250.62", "250.63", "250.7",
    "250.70", "250.71", "250.72", "250.73", "250.8", "250.80", "250.81", "250.82", "250.83",
    "250.9", "250.90", "250.91", "250.92", "250.93", "250.03", "250.11", "250.13", "250.21",
    "250.23", "250.31", "250.33", "250.41", "250.43", "250.51", "250.53", "250.61", "250.63",
    "250.71", "250.73", "250.81", "250.83", "250.91", "250.93", "250.32", "250.2", "250.22",
    "250.9", "250.92", "250.8", "250.82", "250.7", "250.72", "250.6", "250.62", "250.5",
    "250.52", "250.4", "250.42", "250", "250.02",
)

# ---------------------------------------------------------------------------


def _unique(values, lower: bool = False) -> tuple[str, ...]:
    seen: dict[str, None] = {}
    for v in values:
        seen[v.lower() if lower else v] = None
    return tuple(seen)


@dataclass(frozen=True)
class Profile:
    """One consistent choice of code sets and control rule."""

    name: str
    t1dm_dx: tuple[str, ...]
    t2dm_dx: tuple[str, ...]
    t1dm_med: tuple[str, ...]
    t2dm_med: tuple[str, ...]
    dm_related_dx: tuple[str, ...]
    dm_related_prefixes: tuple[str, ...]
    # published rule: an abnormal lab value excludes a patient from the controls
    exclude_abnormal_from_controls: bool


REFERENCE = Profile(
    name="reference",
    t1dm_dx=_unique(REFERENCE_T1DM_DX),
    t2dm_dx=_unique(REFERENCE_T2DM_DX),
    t1dm_med=_unique(REFERENCE_T1DM_MED),
    t2dm_med=_unique(REFERENCE_T2DM_MED),
    dm_related_dx=_unique(REFERENCE_DM_RELATED_DX),
    dm_related_prefixes=(DM_RELATED_PREFIX,),
    exclude_abnormal_from_controls=False,
)

# event names are lower-cased on load, so the published sets are lower-cased too
PUBLISHED = Profile(
    name="published",
    t1dm_dx=_unique(PUBLISHED_T1DM_DX, lower=True),
    t2dm_dx=_unique(PUBLISHED_T2DM_DX, lower=True),
    t1dm_med=_unique(PUBLISHED_T1DM_MED, lower=True),
    t2dm_med=_unique(PUBLISHED_T2DM_MED, lower=True),
    dm_related_dx=_unique(PUBLISHED_DM_RELATED_DX, lower=True),
    dm_related_prefixes=(DM_RELATED_PREFIX,),
    exclude_abnormal_from_controls=True,
)

PROFILES = {p.name: p for p in (REFERENCE, PUBLISHED)}


def get_profile(profile: str | Profile) -> Profile:
    return profile if isinstance(profile, Profile) else PROFILES[profile]


CRITERIA_SCHEMA = T.StructType(
    [
        T.StructField("set_name", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("match_kind", T.StringType(), False),
        T.StructField("term", T.StringType(), False),
    ]
)


def criteria_rows(profile: str | Profile = "reference") -> list[tuple[str, str, str, str]]:
    p = get_profile(profile)
    rows = []
    for set_name, source, terms in (
        ("t1dm_dx", "dx", p.t1dm_dx),
        ("t2dm_dx", "dx", p.t2dm_dx),
        ("t1dm_med", "med", p.t1dm_med),
        ("t2dm_med", "med", p.t2dm_med),
        ("dm_related_dx", "dx", p.dm_related_dx),
    ):
        rows.extend((set_name, source, "exact", t) for t in terms)
    rows.extend(("dm_related_dx", "dx", "prefix", t) for t in p.dm_related_prefixes)
    return rows


def criteria_frame(spark: SparkSession, profile: str | Profile = "reference") -> DataFrame:
    """The code-set dimension ``(set_name, source, match_kind, term)``.

    Fixed size (about a hundred rows), so callers may broadcast it freely.
    """
    return spark.createDataFrame(criteria_rows(profile), CRITERIA_SCHEMA)


# file of each code set in a criteria folder, and whether it holds diagnoses or drugs
CRITERIA_FILES = {"t1dm_dx": "dx", "t2dm_dx": "dx", "t1dm_med": "med", "t2dm_med": "med",
                  "dm_related_dx": "dx"}


def read_criteria(spark: SparkSession, folder: str, column: int = 0) -> DataFrame:
    """S5 from files ``folder/<set_name>.csv``: a header, a code column (the first by
    default) and any further columns, e.g. a description with quoted commas.

    A code ending in ``*`` is a prefix (``250.*`` means every code from ``250`` on).
    Codes are lower-cased like event names; blanks are kept; empty codes are skipped.
    """
    out = None
    for set_name, source in CRITERIA_FILES.items():
        df = (spark.read.option("header", "true").option("ignoreLeadingWhiteSpace", "false")
              .option("ignoreTrailingWhiteSpace", "false").csv(f"{folder}/{set_name}.csv"))
        code = F.lower(F.col(f"`{df.columns[column]}`"))
        prefix = code.endswith("*")
        rows = df.where(code.isNotNull() & (code != "")).select(
            F.lit(set_name).alias("set_name"), F.lit(source).alias("source"),
            F.when(prefix, "prefix").otherwise("exact").alias("match_kind"),
            F.when(prefix, F.regexp_replace(code, "[.]?[*]$", "")).otherwise(code).alias("term"))
        out = rows if out is None else out.unionByName(rows)
    return out.distinct()


def write_criteria(spark: SparkSession, profile: str | Profile, folder: str) -> None:
    """Write a profile as criteria files (see ``read_criteria``)."""
    for set_name in CRITERIA_FILES:
        rows = [(t + (".*" if kind == "prefix" else ""), f"{set_name}, {kind}")
                for name, _, kind, t in criteria_rows(profile) if name == set_name]
        (spark.createDataFrame(rows, "code string, description string").write.mode("overwrite")
         .option("header", "true").option("ignoreLeadingWhiteSpace", "false")
         .option("ignoreTrailingWhiteSpace", "false").csv(f"{folder}/{set_name}.csv"))


def lab_rules_frame(spark: SparkSession) -> DataFrame:
    """P12 rule table ``(test_name, op, threshold)``; seven fixed rows."""
    return spark.createDataFrame(
        list(ABNORMAL_LAB_RULES), "test_name string, op string, threshold double"
    )


def candidate_terms(kind: str) -> tuple[str, ...]:
    """Lower-cased, de-duplicated candidate list (``med``, ``lab`` or ``dx``), not trimmed."""
    raw = {"med": CANDIDATE_MEDICATIONS, "lab": CANDIDATE_LABS, "dx": CANDIDATE_DIAGNOSES}[kind]
    return _unique(raw, lower=True)


def candidate_frame(spark: SparkSession, kind: str) -> DataFrame:
    return spark.createDataFrame([(t,) for t in candidate_terms(kind)], "term string")
