"""Scaler, PCA, clustering experiment and the online k-means update."""

import numpy as np
import pytest
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.linalg import Vectors

from phenoscope.operators import features as feat
from phenoscope.plans.learn import (
    ClusteringExperiment,
    feature_moments,
    kmeans_step,
    Projection,
)
from phenoscope.streaming.online_kmeans import OnlineKMeans, apply_update, nearest_centre


def _long(spark):
    rows = [("p1", "a", 1.0), ("p1", "c", 5.0), ("p2", "a", 3.0), ("p2", "b", 2.0),
            ("p3", "c", 1.0), ("p4", "a", 2.0), ("p4", "b", 2.0), ("p4", "c", 7.0)]
    t = spark.createDataFrame(rows, "patient_id string, feature string, value double")
    d = feat.feature_dictionary(t)
    return feat.feature_matrix_long(t, d), d.count()


def test_moments_match_scaler_with_implicit_zeros(spark):
    long, width = _long(spark)
    m = {r.idx: (r.mean, r.std) for r in feature_moments(long, 4).collect()}
    vecs = feat.dense_patient_vectors(long, width)
    model = StandardScaler(inputCol="features", withMean=True, withStd=True).fit(vecs)
    for j in range(width):
        assert m[j][0] == pytest.approx(model.mean[j])
        assert m[j][1] == pytest.approx(model.std[j])


def test_projection_equals_centred_scaling_and_pca(spark):
    rows = [(f"p{i}", Vectors.dense([1.0, float(i), float(i * i % 7)])) for i in range(6)]
    df = spark.createDataFrame(rows, ["patient_id", "features"])
    out = {r.patient_id: r.pca.toArray() for r in Projection(3).fit(df).transform(df).collect()}
    scaled = StandardScaler(inputCol="features", outputCol="s", withMean=True, withStd=True).fit(df).transform(df)
    plain = {r.patient_id: r.p.toArray() for r in
             PCA(k=3, inputCol="s", outputCol="p").fit(scaled).transform(scaled).collect()}
    assert all(len(x) == 3 for x in out.values())  # width 3 < 10 components
    for p in out:  # a component's sign is free; the constant column has no part in the first two
        assert np.abs(out[p])[:2] == pytest.approx(np.abs(plain[p])[:2])


def test_experiment_assignments_keep_ids(spark):
    rng = np.random.RandomState(1)
    rows = []
    for i in range(60):
        centre = [0.0, 0.0, 0.0] if i % 2 else [9.0, 9.0, 0.0]
        rows.append((f"p{i}", Vectors.dense(np.add(centre, rng.rand(3)).tolist())))
    vecs = spark.createDataFrame(rows, ["patient_id", "features"])
    labels = spark.createDataFrame([(f"p{i}", 1 + i % 2) for i in range(60)],
                                   "patient_id string, label int")
    exp = ClusteringExperiment().fit(vecs, 3)
    for algo in ("kmeans", "gmm", "streaming_kmeans"):
        a = exp.assignments(algo)
        assert a.count() == 60 and a.select("patient_id").distinct().count() == 60
    report = {r.algorithm: r for r in exp.purity_report(labels).collect()}
    assert report["kmeans"].purity == pytest.approx(1.0)
    assert all(r.n == 60 for r in report.values())
    scored = exp.score(vecs.limit(5))
    assert scored.count() == 5


def _points(spark):
    rng = np.random.RandomState(7)
    pts = np.vstack([rng.randn(40, 2) + [5, 5], rng.randn(30, 2) - [5, 5], rng.randn(30, 2)])
    return pts, spark.createDataFrame([(i, Vectors.dense(p.tolist())) for i, p in enumerate(pts)],
                                      ["id", "features"])


@pytest.mark.parametrize("decay,unit", [(1.0, "batches"), (0.5, "batches"), (0.999, "points")])
def test_online_update_matches_mllib(spark, decay, unit):
    from pyspark.mllib.clustering import StreamingKMeansModel
    from pyspark.mllib.linalg import Vectors as MV

    pts, df = _points(spark)
    centres = np.array([[4.0, 4.0], [-4.0, -4.0], [0.5, 0.0]])
    weights = [0.5, 0.5, 0.5]
    ours = OnlineKMeans(3, decay, unit).set_centres(centres, weights)
    ref = StreamingKMeansModel([MV.dense(c) for c in centres], list(weights))
    rdd = spark.sparkContext.parallelize([MV.dense(p) for p in pts], 4)
    for _ in range(2):
        ours.update(df)
        ref = ref.update(rdd, decay, unit)
    np.testing.assert_allclose(ours.state.centres, np.array(ref.centers), rtol=1e-12, atol=1e-12)
    np.testing.assert_allclose(ours.state.weights, np.array(ref.clusterWeights), rtol=1e-12)
    got = {r.id: r.cluster for r in ours.predict(df).collect()}
    exp = ref.predict(rdd).collect()
    assert [got[i] for i in range(len(pts))] == exp


def test_dying_cluster_is_split():
    c, w = apply_update(np.array([[0.0, 0.0], [10.0, 10.0]]), np.array([1e-12, 1.0]),
                        {1: (100, np.array([1000.0, 1000.0]))})
    assert w[0] == w[1]
    assert c[0][0] < 10.0 < c[1][0]


def test_nearest_centre_ties_take_lowest_index(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0])], "id int, features array<double>")
    got = nearest_centre(df, np.array([[1.0, 0.0], [-1.0, 0.0]])).first().cluster
    assert got == 0


def test_lloyd_step_means(spark):
    df = spark.createDataFrame([(0, [0.0]), (1, [2.0]), (2, [10.0])], "id int, features array<double>")
    got = {r.cluster: r.centre for r in kmeans_step(df, np.array([[1.0], [9.0]])).collect()}
    assert got == {0: [1.0], 1: [10.0]}


def test_arm_without_features_reports_null_purity(spark, events):
    from phenoscope.plans.learn import experiment_report

    dx, med, lab = events(dx=[("p1", "2010-01-01T00:00:00", "x1")],
                          med=[("p2", "2010-01-01T00:00:00", "aspirin")])
    labels = spark.createDataFrame([("p1", 3), ("p2", 3)], "patient_id string, label int")
    rows = {(r.arm, r.algorithm): r for r in experiment_report(dx, med, lab, labels).collect()}
    # no event matches a candidate term: the filtered arm is empty
    assert all(rows[("filtered", a)].n == 0 and rows[("filtered", a)].purity is None
               for a in ("kmeans", "gmm", "streaming_kmeans"))
