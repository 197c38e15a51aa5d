"""Physical plan shapes the scale design depends on."""

import re

import pytest

from phenoscope.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
# fitted-model queries run Spark ML jobs while they are built
FITTED = {"pca_projection", "kmeans_assign", "gmm_assign", "online_kmeans_assign",
          "experiment_report", "standardised_values", "covariance_entries", "pca_certificate",
          "kmeans_certificate", "online_kmeans_certificate", "gmm_certificate", "experiment_certificate",
          "score_new_patients"}


def _plan(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    return df._jdf.queryExecution().executedPlan().toString(), df


def _formatted(df):
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_labelling_is_one_shuffle_on_patient(spark):
    plan, _ = _plan(spark, "phenotype_labels")
    shuffles = re.findall(r"Exchange hashpartitioning\(([^,]+)", plan)
    assert len(shuffles) == 1 and shuffles[0].startswith("patient_id")
    assert "SortMergeJoin" not in plan


def test_first_drug_dates_aggregate_without_join(spark):
    plan, _ = _plan(spark, "first_drug_dates")
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    _, df = _plan(spark, "lab_extract")
    text = _formatted(df)
    assert "EqualTo(l_returnflag,N)" in text
    lineitem_schema = [s for s in re.findall(r"ReadSchema: (struct<[^\n]*>)", text)
                       if "l_orderkey" in s][0]
    for unused in ("l_extendedprice", "l_discount", "l_tax", "l_suppkey", "l_linestatus"):
        assert unused not in lineitem_schema


def test_code_sets_are_broadcast_not_nested_loops(spark):
    plan, _ = _plan(spark, "code_set_members")
    assert "BroadcastHashJoin" in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FITTED))
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan, _ = _plan(spark, name)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_feature_tuples_are_one_aggregation(spark):
    plan, _ = _plan(spark, "feature_tuples")
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(shuffles) == 1
    assert all(k in shuffles[0] for k in ("patient_id", "feature", "kind"))


@pytest.mark.parametrize("name", ["patients_without_t1dx", "patients_with_both_drugs"])
def test_set_operations_collapse_hot_keys_before_the_shuffle(spark, name):
    plan, _ = _plan(spark, name)
    lines = [x.strip(" +-:*()0123456789") for x in plan.splitlines()]
    for i, line in enumerate(lines):
        if line.startswith("Exchange hashpartitioning"):
            assert "HashAggregate" in lines[i + 1], plan


@pytest.mark.parametrize("name", sorted({"feature_vectors", "covariance_entries", "score_new_patients",
                                         "online_kmeans_assign", "nearest_centre", "kmeans_one_step"}))
def test_no_python_on_the_executors(spark, name):
    plan, _ = _plan(spark, name)
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_the_experiment_extracts_its_events_once(spark, monkeypatch):
    from phenoscope.plans import context

    made = []
    for name in ("extract_diagnoses", "extract_medications", "extract_labs"):
        monkeypatch.setattr(context, name, lambda *a, f=getattr(context, name), n=name, **k: made.append(n) or f(*a, **k))
    for query in ("experiment_certificate", "experiment_report"):
        made.clear()
        files = QUERIES[query](spark, SF_DIR).inputFiles()
        assert sorted(made) == ["extract_diagnoses", "extract_labs", "extract_medications"]
        assert not [f for f in files if SF_DIR in f]  # nothing is left to be extracted again
