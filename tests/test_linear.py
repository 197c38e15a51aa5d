"""Sums over sparse vectors, components by block products, EM steps, saved projections."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from phenoscope.operators import features as feat
from phenoscope.operators import linear
from phenoscope.plans import learn
from phenoscope.plans.queries import mixture_fits
from phenoscope.session import reliable_checkpoint, scratch_path, scratch_scope


def _sparse(spark, rows, width):
    """Random sparse rows as a matrix and as vectors; the last column is constant."""
    rng = np.random.RandomState(3)
    x = np.where(rng.rand(rows, width) < 0.2, rng.randint(1, 9, (rows, width)), 0).astype(float)
    x[:, 0] += 3 * x[:, 1]
    x[:, -1] = 2.0
    data = [(f"p{i}", Vectors.sparse(width, [(int(j), float(r[j])) for j in np.flatnonzero(r)])) for i, r in enumerate(x)]
    return x, spark.createDataFrame(data, ["patient_id", "features"]).repartition(5)


def _long(spark, x):
    rows = [(f"p{i}", int(j), float(r[j])) for i, r in enumerate(x) for j in np.flatnonzero(r)]
    return spark.createDataFrame(rows, "patient_id string, idx long, value double")


@pytest.mark.parametrize("limit", [1 << 20, 7])
def test_gram_entries(spark, monkeypatch, limit):
    monkeypatch.setattr(linear, "PRODUCTS", limit)
    monkeypatch.setattr(linear, "HELD", limit)
    x, _ = _sparse(spark, 60, 12)
    got = {(r.i, r.j): r.s for r in linear.gram_entries(feat.patient_entries(_long(spark, x)), 12).collect()}
    full = x.T @ x
    assert got == {(i, j): pytest.approx(full[i, j]) for i in range(12) for j in range(i, 12) if full[i, j]}


def test_no_generator_multiplies_entries_by_entries(spark):
    x, _ = _sparse(spark, 30, 8)
    plan = linear.gram_entries(feat.patient_entries(_long(spark, x)), 8)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan and "MapInArrow" in plan


def test_components_of_a_wide_vocabulary(spark):
    """More features than rows of any basis; a basis that has to be cut back."""
    x, vectors = _sparse(spark, 200, 90)
    p = learn.Projection(90).fit(vectors)
    used = x.std(axis=0) > 0
    z = np.where(used, (x - x.mean(axis=0)) / np.where(used, x.std(axis=0, ddof=1), 1), 0)
    c = np.cov(z.T)
    values = np.linalg.eigvalsh(c)[::-1]
    assert p.variances == pytest.approx(values[:10], abs=1e-8)
    assert np.abs(c @ p.components - p.components * p.variances).max() < 1e-8 and p.residuals.max() < 1e-8
    assert np.abs(p.components.T @ p.components - np.eye(10)).max() < 1e-10
    got = {r.patient_id: r.pca.toArray() for r in p.transform(vectors).collect()}
    for i in range(200):
        assert got[f"p{i}"] == pytest.approx(z[i] @ p.components, abs=1e-8)


def test_a_basis_that_is_cut_back(monkeypatch):
    monkeypatch.setattr(linear, "BASIS_BYTES", 0)
    rng = np.random.RandomState(5)
    a = rng.randn(150, 150)
    c = a @ a.T
    values, vectors, residuals = linear.leading_eigenvectors(lambda v: c @ v, 150, 4, 1)
    assert values == pytest.approx(np.linalg.eigvalsh(c)[::-1][:4]) and residuals.max() < 1e-7 * values[0]
    zero = linear.leading_eigenvectors(lambda v: 0 * v, 3, 3, 1)
    assert zero[0] == pytest.approx([0, 0, 0])


def test_a_saved_projection(spark, tmp_path):
    x, vectors = _sparse(spark, 50, 12)
    p = learn.Projection(12).fit(vectors)
    p.write().save(str(tmp_path / "m"))
    q = learn.Projection.load(str(tmp_path / "m"))
    want = {r.patient_id: r.pca.toArray().tolist() for r in p.transform(vectors).collect()}
    assert {r.patient_id: r.pca.toArray().tolist() for r in q.transform(vectors).collect()} == want
    assert (q.variances == p.variances).all() and q.cfg == p.cfg
    dense = spark.createDataFrame([("a", Vectors.dense(x[0].tolist()), 7)], ["patient_id", "features", "further"])
    out = q.transform(dense).first()
    assert out.further == 7 and out.pca.toArray() == pytest.approx(p.transform(dense).first().pca.toArray())
    with pytest.raises(Exception):
        p.write().save(str(tmp_path / "m"))


def test_sparse_standardisation(spark):
    x, _ = _sparse(spark, 40, 9)
    entries, baseline = learn.standardised_entries(_long(spark, x), 40)
    z = np.zeros_like(x)
    for r in baseline.collect():
        z[:, r.idx] += r.value
    n = 0
    for r in entries.collect():
        z[int(r.patient_id[1:]), r.idx] += r.value
        n += 1
    assert n == np.count_nonzero(x)
    used = x.std(axis=0) > 0
    assert z[:, used] == pytest.approx(((x - x.mean(axis=0)) / np.where(used, x.std(axis=0, ddof=1), 1))[:, used])
    assert (z[:, ~used] == 0).all()


def test_em_step_and_its_certificate(spark):
    rng = np.random.RandomState(2)
    x = np.vstack([rng.randn(80, 3) * [1, 2, 1] + [6, 0, 0], rng.randn(40, 3) + [0, 5, 1]])
    df = spark.createDataFrame([(r.tolist(),) for r in x], "features array<double>").repartition(4)
    weights, means = np.array([0.3, 0.7]), np.array([[5.0, 1, 0], [0, 4, 0]])
    cov = np.stack([np.diag([2.0, 3, 1]), np.eye(3) + 0.3])
    logs = np.stack([np.log(w) - 0.5 * np.linalg.slogdet(2 * np.pi * c)[1]
                     - 0.5 * (((x - m) @ np.linalg.inv(c)) * (x - m)).sum(axis=1) for w, m, c in zip(weights, means, cov)], 1)
    r = np.exp(logs) / np.exp(logs).sum(axis=1, keepdims=True)
    w, m, c, likelihood = linear.em_step(df, weights, means, cov)
    assert likelihood == pytest.approx(np.log(np.exp(logs).sum(axis=1)).sum())
    assert w == pytest.approx(r.mean(axis=0))
    for j in range(2):
        mean = r[:, j] @ x / r[:, j].sum()
        assert m[j] == pytest.approx(mean)
        assert c[j] == pytest.approx((x - mean).T @ ((x - mean) * r[:, j:j + 1]) / r[:, j].sum())
    assert mixture_fits(df, w, m, c, "features") == (True, True)
    wrong = [[3.0, 3.0, 9.0], [0.0, 1.0, -9.0]]
    assert mixture_fits(df, [0.5, 0.5], wrong, [25 * np.eye(3)] * 2, "features") == (True, False)


def test_scratch_scope_removes_its_tables(spark, tmp_path):
    made = []
    with pytest.raises(RuntimeError):
        with scratch_scope(spark) as folders:
            made.append(scratch_path(spark, "t"))
            spark.range(3).write.parquet(made[0])
            assert reliable_checkpoint(spark.range(5)).count() == 5
            assert len(folders) == 2
            made += folders
            raise RuntimeError
    jvm = spark.sparkContext._jvm
    for path in made:
        p = jvm.org.apache.hadoop.fs.Path(path)
        assert not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
    assert scratch_path(spark, "t") not in made  # outside a scope nothing is registered


def test_experiment_report_leaves_no_scratch(spark):
    from pathlib import Path

    from phenoscope.plans.queries import QUERIES
    from phenoscope.session import checkpoint_root

    root = Path(checkpoint_root(spark).removeprefix("file:"))
    before = {p for p in root.rglob("*") if p.is_dir()}
    assert QUERIES["experiment_report"](spark, "/root/testdata/sf0.001").count() == 6
    assert {p for p in root.rglob("*") if p.is_dir()} == before


def test_seeds_do_not_depend_on_the_layout(spark, tmp_path):
    rng = np.random.RandomState(8)
    x = np.vstack([rng.randn(60, 2) + c for c in ([0, 0], [9, 0], [0, 9])])
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, features array<double>")
    found = []
    for files in (1, 16):
        df.repartition(files).write.parquet(str(tmp_path / str(files)))
        stored = spark.read.parquet(str(tmp_path / str(files)))
        found.append((learn.kmeans_candidates(stored, "id", "features", 3, 5), learn.seeded_kmeans(stored, "id", "features", 3, 5)))
    assert found[0][0] == found[1][0] and found[0][1] == pytest.approx(found[1][1])
    candidates, centres = found[0]
    assert sum(n for *_, n in candidates) == len(x) and 3 <= len(candidates) <= 30
    assert sorted(np.round(centres).astype(int).tolist()) == [[0, 0], [0, 9], [9, 0]]
    assert learn.kmeans_candidates(df.limit(0), "id", "features", 3, 5) == []
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "id long, features array<double>")
    assert learn.seeded_kmeans(same, "id", "features", 3, 5).tolist() == [[1.0, 2.0]]


def test_a_query_plans_only_the_extracts_it_reads(spark, monkeypatch):
    from phenoscope.plans.context import load_events
    from phenoscope.sources import standin

    asked = []
    monkeypatch.setattr(standin, "RAW_TABLES", {
        k: lambda *a, k=k, f=f: asked.append(k) or f(*a) for k, f in standin.RAW_TABLES.items()})
    events = load_events(spark, "/root/testdata/sf0.001")
    assert events.med is events.med and asked == ["medication_orders_INPUT"]
