"""Set operations keep the original's bag semantics; report formatting; sizing."""

from phenoscope.operators.setops import bag_union, difference, distinct, intersection
from phenoscope.plans.learn import report_lines
from phenoscope.session import shuffle_partitions_for


def _ids(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "patient_id string")


def test_difference_keeps_left_duplicates(spark):
    a, b = _ids(spark, ["p1", "p1", "p2", "p3"]), _ids(spark, ["p3"])
    assert sorted(r.patient_id for r in difference(a, b).collect()) == ["p1", "p1", "p2"]
    assert sorted(r.patient_id for r in difference(a, b, keep_duplicates=False).collect()) == [
        "p1", "p2"]


def test_intersection_deduplicates(spark):
    a, b = _ids(spark, ["p1", "p1", "p2"]), _ids(spark, ["p1", "p3", "p1"])
    assert [r.patient_id for r in intersection(a, b).collect()] == ["p1"]


def test_union_is_bag_and_distinct(spark):
    u = bag_union(_ids(spark, ["p1"]), _ids(spark, ["p1", "p2"]))
    assert u.count() == 3 and distinct(u).count() == 2


def test_report_lines(spark):
    rows = [(a, g, 10, p) for a in ("all", "filtered")
            for g, p in (("kmeans", 0.5), ("gmm", 0.25), ("streaming_kmeans", None))]
    df = spark.createDataFrame(rows, "arm string, algorithm string, n long, purity double")
    lines = report_lines(df)
    assert lines[:2] == ["[All feature] patients: 10", "[Filtered feature] patients: 10"]
    lines = lines[2:]
    assert lines[0] == "[All feature] purity of kMeans is: 0.50000"
    assert lines[1] == "[All feature] purity of GMM is: 0.25000"
    assert lines[2] == "[All feature] purity of StreamingKmeans is: null"
    assert lines[3].startswith("[Filtered feature] purity of kMeans")


def test_shuffle_partitions_for():
    assert shuffle_partitions_for(0) == 8
    assert shuffle_partitions_for(2**40) == 4096
    assert shuffle_partitions_for(100 * 2**40) == 409_600
