"""Scaling, projection, clustering and scoring of patient vectors
(A11, A12, M4-M9, M11, M13, M14, S8).

The clusterings run in ``pyspark.ml`` (distributed Lloyd / EM steps via tree
aggregation); the principal components come from block products over the sparse
vectors (``operators/linear.py``), so no d × d matrix exists for d features.  The driver
holds only fitted parameters: the scaler's d means and stds, a basis of d × some
tens of columns, k centres / Gaussians.
"""

from __future__ import annotations

import contextvars
import json
import threading
from dataclasses import asdict, dataclass

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as feat
from ..operators.linear import gram_entries, leading_eigenvectors, project, second_moment_times
from ..operators.metrics import assignments_with_labels, purity
from ..session import broadcast_if_small, reliable_checkpoint, scratch_scope
from ..sources.criteria import candidate_terms
from ..streaming.online_kmeans import OnlineKMeans

ALGORITHMS = ("kmeans", "gmm", "streaming_kmeans")

# Each Gaussian-mixture iteration decomposes its k covariance matrices with LAPACK on
# the driver; its pure-Java fallback keeps static state, so two such calls must never
# overlap in one driver.
_DRIVER_LAPACK = threading.Lock()


def _locked(fn, *args):
    with _DRIVER_LAPACK:
        return fn(*args)


def run_concurrently(spark: SparkSession, tasks):
    """Run independent driver-side callables that each submit Spark jobs, in
    threads that inherit the caller's job group, pool and tags, so small iterative
    jobs share the cluster.  Results come in order; the first error is raised."""
    from concurrent.futures import ThreadPoolExecutor

    if len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        inherit = inheritable_thread_target(spark)
        futures = [pool.submit(contextvars.copy_context().run, inherit(t)) for t in tasks]
        return [f.result() for f in futures]


@dataclass(frozen=True)
class ClusteringConfig:
    """Defaults are the original experiment's settings."""

    k: int = 3
    max_iter: int = 20
    seed: int = 6250
    n_components: int = 10
    init_mode: str = "k-means||"
    init_steps: int = 1
    online_decay: float = 1.0
    online_weight: float = 0.5
    online_time_unit: str = "batches"


def feature_moments(long: DataFrame, n_rows: int) -> DataFrame:
    """A11 in long form: per feature index, mean and sample std over ``n_rows``
    patients **including the implicit zeros** of sparse rows, without densifying.

    One pass: mean and variance of the stored values, merged in closed form with
    the ``n - nnz`` zeros (no cancellation, no join, pre-aggregated per task)."""
    n = F.lit(float(n_rows))
    stored = long.groupBy("idx").agg(F.count("value").cast("double").alias("nnz"),
                                     F.avg("value").alias("m"), F.var_pop("value").alias("v"))
    nnz, m, v = F.col("nnz"), F.col("m"), F.col("v")
    squares = nnz * v + m * m * nnz * (n - nnz) / n
    return stored.select("idx", (m * nnz / n).alias("mean"), F.sqrt(squares / (n - 1.0)).alias("std"))


def covariance_long(long: DataFrame, n_rows: int, width: int, in_tasks: bool = True) -> DataFrame:
    """``(i, j, value)``, the covariance of the standardised features that PCA
    decomposes (their correlation; 0 for constant features).

    Products of a patient's stored entries are summed inside the tasks before they are
    shuffled; the patient's list is bounded by the vocabulary.  The result has width²
    rows by definition and never passes the driver.

    ``in_tasks=False`` makes a row of each product of a patient's entries instead, with
    JVM expressions alone: for narrow patients."""
    n = float(n_rows)
    moments = feature_moments(long, n_rows)
    lists = feat.patient_entries(long)
    if in_tasks:
        half = gram_entries(lists, width)
        products = half.unionByName(half.where("i < j").select(F.col("j").alias("i"), F.col("i").alias("j"), "s"))
    else:
        x = lists.select(F.explode("entries").alias("x"), "entries")
        products = (x.select(F.col("x.idx").alias("i"), F.col("x.value").alias("a"), F.explode("entries").alias("y"))
                    .groupBy("i", F.col("y.idx").alias("j")).agg(F.sum(F.col("a") * F.col("y.value")).alias("s")))
    mi = moments.select(F.col("idx").alias("i"), F.col("mean").alias("mean_i"), F.col("std").alias("std_i"))
    mj = moments.select(F.col("idx").alias("j"), F.col("mean").alias("mean_j"), F.col("std").alias("std_j"))
    grid = mi.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(width - 1).cast("long"))).alias("j"))
    joined = grid.join(broadcast_if_small(mj), "j").join(products, ["i", "j"], "left")
    value = (F.coalesce("s", F.lit(0.0)) - n * F.col("mean_i") * F.col("mean_j")) / (n - 1.0)
    scale = F.col("std_i") * F.col("std_j")
    return joined.select(F.col("i").cast("int").alias("i"), F.col("j").cast("int").alias("j"),
                         F.when(scale == 0, 0.0).otherwise(value / scale).alias("value"))


def standardised_entries(long: DataFrame, n_rows: int) -> tuple[DataFrame, DataFrame]:
    """M4 without the dense table: ``(patient_id, idx, value)`` of the stored entries, each
    ``x / std``, and ``(idx, value)`` of the baseline ``-mean / std``.  A patient's
    standardised value is the baseline, plus its entry where it has one; constant
    features count 0."""
    moments = feature_moments(long, n_rows)
    own = broadcast_if_small(moments.select("idx", "std"))
    scaled = F.when(F.col("std") > 0, F.col("value") / F.col("std")).otherwise(0.0)
    entries = long.join(own, "idx").select("patient_id", "idx", scaled.alias("value"))
    base = F.when(F.col("std") > 0, -F.col("mean") / F.col("std")).otherwise(0.0)
    return entries, moments.select("idx", base.alias("value"))


class Projection(Model, MLWritable, MLReadable):
    """M4 + M5: standardise and project onto ``min(n_components, width)`` principal
    components.

    Vectors stay sparse: the components are those of the centred, standardised features,
    but centring is a term of rank one in each product and a constant (k numbers) in the
    result.  No vocabulary x vocabulary matrix exists anywhere; a pass over the vectors
    brings back vocabulary x components.  Constant features count 0.  A fitted
    projection is a transformer that can be saved and loaded."""

    def __init__(self, width: int = 0, cfg: ClusteringConfig = ClusteringConfig(),
                 input_col: str = "features"):
        super().__init__()
        self.width, self.cfg, self.input_col = width, cfg, input_col

    def _sparse(self, vectors: DataFrame, *keep: str) -> DataFrame:
        """``(indices, values)`` of sparse and dense vectors alike."""
        v = F.unwrap_udt(self.input_col)
        sparse = v["type"] == 0
        return vectors.select(
            *keep, F.when(sparse, v["indices"]).otherwise(F.sequence(F.lit(0), F.size(v["values"]) - 1)).alias("indices"),
            v["values"].alias("values"))

    def fit(self, vectors: DataFrame) -> Projection:
        k = max(1, min(self.cfg.n_components, self.width))
        row = vectors.agg(Summarizer.metrics("count", "mean", "std").summary(F.col(self.input_col)).alias("s")).first().s
        n, self.mean, self.std = int(row["count"]), row["mean"].toArray(), row["std"].toArray()
        inverse = np.divide(1.0, self.std, out=np.zeros_like(self.std), where=self.std > 0)
        own = self._sparse(vectors)
        mean = self.mean * inverse

        def covariance_times(block):
            moment = inverse[:, None] * second_moment_times(own, inverse[:, None] * block)
            return (moment - n * np.outer(mean, mean @ block)) / max(1, n - 1)

        self.variances, self.components, self.residuals = leading_eigenvectors(
            covariance_times, self.width, k, self.cfg.seed)
        self.offset = mean @ self.components
        return self

    @property
    def weights(self) -> np.ndarray:
        """What an entry's value is multiplied with, vocabulary x components."""
        return np.divide(self.components, self.std[:, None], out=np.zeros_like(self.components),
                         where=self.std[:, None] > 0)

    def _transform(self, vectors: DataFrame) -> DataFrame:
        rest = [c for c in vectors.columns if c != self.input_col]
        out = project(self._sparse(vectors, *rest), self.weights, "_pca", rest)
        offset = F.array(*[F.lit(float(x)) for x in self.offset])
        return out.select(*rest, array_to_vector(F.zip_with("_pca", offset, lambda a, b: a - b)).alias("pca"))

    def transform(self, dataset: DataFrame, params=None) -> DataFrame:
        """``dataset`` with ``pca`` in the place of the input vectors."""
        return self._transform(dataset)

    def write(self):
        return _ProjectionWriter(self)

    @classmethod
    def read(cls):
        return _ProjectionReader()


class _ProjectionWriter(MLWriter):
    """Two Parquet tables: a row per feature, and the constants."""

    def __init__(self, projection: Projection):
        super().__init__()
        self.projection = projection

    def saveImpl(self, path: str) -> None:
        p, spark = self.projection, self.sparkSession
        rows = [(i, float(p.mean[i]), float(p.std[i]), p.components[i].tolist()) for i in range(p.width)]
        spark.createDataFrame(rows, "idx long, mean double, std double, components array<double>").write.parquet(f"{path}/features")
        spark.createDataFrame([(p.input_col, p.width, p.variances.tolist(), p.residuals.tolist(), json.dumps(asdict(p.cfg)))],
                              "input_col string, width int, variances array<double>, residuals array<double>, config string"
                              ).coalesce(1).write.parquet(f"{path}/constants")


class _ProjectionReader(MLReader):
    def load(self, path: str) -> Projection:
        one = self.sparkSession.read.parquet(f"{path}/constants").first()
        rows = sorted(self.sparkSession.read.parquet(f"{path}/features").collect(), key=lambda r: r.idx)
        p = Projection(one.width, ClusteringConfig(**json.loads(one.config)), one.input_col)
        p.mean, p.std = (np.array([r[c] for r in rows]) for c in ("mean", "std"))
        p.components = np.array([r.components for r in rows])
        p.variances, p.residuals = np.array(one.variances), np.array(one.residuals)
        inverse = np.divide(1.0, p.std, out=np.zeros_like(p.std), where=p.std > 0)
        p.offset = (p.mean * inverse) @ p.components
        return p


class ClusteringExperiment:
    """Scale → PCA → k-means, GMM and one online k-means update, each
    scored by purity against phenotype labels.

    Input rows are hash-partitioned and sorted by patient id before fitting, so
    seeded initialisations see the same data layout run after run; the
    projected matrix is written to the checkpoint folder once and read by all
    three algorithms (lineage cut, survives executor loss).
    """

    def __init__(self, cfg: ClusteringConfig = ClusteringConfig()):
        self.cfg = cfg
        self.projection: Projection | None = None
        self.projected: DataFrame | None = None
        self.models: dict = {}

    def fit(self, vectors: DataFrame, width: int, algorithms=ALGORITHMS,
            ordered: bool = False) -> ClusteringExperiment:
        """``ordered=True`` when ``vectors`` already come partitioned and sorted
        by patient id (as from ``patient_matrix``)."""
        cfg = self.cfg
        if not ordered:
            vectors = vectors.repartition("patient_id").sortWithinPartitions("patient_id")
        self.projection = Projection(width, cfg).fit(vectors)
        projected = self.projection.transform(vectors).select("patient_id", "pca")
        self.projected = reliable_checkpoint(projected)
        dim = max(1, min(cfg.n_components, width))
        fitters = {
            "kmeans": lambda: KMeans(
                k=cfg.k, maxIter=cfg.max_iter, initMode=cfg.init_mode,
                initSteps=cfg.init_steps, seed=cfg.seed, featuresCol="pca",
                predictionCol="cluster",
            ).fit(self.projected),
            "gmm": lambda: _locked(GaussianMixture(
                k=cfg.k, maxIter=cfg.max_iter, seed=cfg.seed, featuresCol="pca",
                predictionCol="cluster", probabilityCol="probability",
            ).fit, self.projected),
            "streaming_kmeans": lambda: (
                OnlineKMeans(cfg.k, cfg.online_decay, cfg.online_time_unit, features_col="pca")
                .set_random_centres(dim, cfg.online_weight, cfg.seed)
                .update(self.projected)
            ),
        }
        wanted = [a for a in ALGORITHMS if a in algorithms]
        # independent fits over the same stored matrix: submitted as concurrent
        # Spark jobs (each seeded, so results do not depend on the overlap)
        self.models = dict(zip(wanted, run_concurrently(vectors.sparkSession, [fitters[a] for a in wanted])))
        return self

    def assignments(self, algorithm: str) -> DataFrame:
        """``(patient_id, cluster)``; the id travels with its row (no zip by
        position)."""
        model = self.models[algorithm]
        out = model.predict(self.projected) if algorithm == "streaming_kmeans" else \
            model.transform(self.projected)
        return out.select("patient_id", F.col("cluster").cast("int").alias("cluster"))

    def score(self, vectors: DataFrame) -> DataFrame:
        """M7: project new patients with the fitted scaler and components."""
        return self.projection.transform(vectors).select("patient_id", "pca")

    def purity_report(self, labels: DataFrame) -> DataFrame:
        """``(algorithm, n, purity)``, one row per algorithm (J4 + M12)."""
        rows = None
        for name in self.models:
            p = purity(assignments_with_labels(self.assignments(name), labels), "cluster", "label")
            p = p.select(F.lit(name).alias("algorithm"), "n", "purity")
            rows = p if rows is None else rows.unionByName(p)
        return rows


def patient_matrix(tuples: DataFrame) -> tuple[DataFrame, int]:
    """Feature tuples → ``(patient_id, features)`` sparse vectors and their width.

    The tuples should be stored (they are read for the dictionary and the join);
    the vectors are written once, sorted by patient id inside their partitions.
    """
    dictionary = feat.feature_dictionary(tuples)
    width = dictionary.count()
    return feat.patient_vectors(feat.feature_matrix_long(tuples, dictionary), width), width


def empty_report(spark, arm: str) -> DataFrame:
    """An arm without any feature: nothing to cluster, ``n = 0``, NULL purity."""
    return spark.createDataFrame([(arm, a, 0, None) for a in ALGORITHMS],
                                 "arm string, algorithm string, n long, purity double")


def experiment_report(dx: DataFrame, med: DataFrame, lab: DataFrame, labels: DataFrame,
                      cfg: ClusteringConfig = ClusteringConfig(), candidates: dict | None = None) -> DataFrame:
    """M14 + S8: both arms (all features, candidate features) × three
    algorithms → ``(arm, algorithm, n, purity)``.  ``n`` differs between arms:
    patients without any candidate feature drop out of the second.

    Events are aggregated once; the candidate arm is a filter on the stored tuples."""
    if candidates is None:
        candidates = {kind: candidate_terms(kind) for kind in ("dx", "med", "lab")}
    spark = labels.sparkSession
    # the six rows are collected inside the scope, so no table of the run outlives it
    with scratch_scope(spark):
        stored = reliable_checkpoint(labels)  # read by six purity joins
        tuples = reliable_checkpoint(feat.feature_tuples(dx, med, lab, with_kind=True))
        arms = {"all": tuples, "filtered": feat.candidate_tuples(tuples, candidates)}

        def arm_report(arm, own):
            vectors, width = patient_matrix(own.drop("kind"))
            if width == 0:
                return empty_report(spark, arm).collect()
            exp = ClusteringExperiment(cfg).fit(vectors, width, ordered=True)
            return exp.purity_report(stored).select(F.lit(arm).alias("arm"), "*").collect()

        parts = run_concurrently(spark, [lambda a=a, t=t: arm_report(a, t) for a, t in arms.items()])
    return spark.createDataFrame([tuple(r) for part in parts for r in part],
                                 "arm string, algorithm string, n long, purity double")


def kmeans_step(df: DataFrame, centres, features_col: str = "features") -> DataFrame:
    """One Lloyd step of k-means (M8): assign to the nearest centre, then
    ``(cluster, centre)`` with the mean of each non-empty cluster."""
    from ..streaming.online_kmeans import as_array, nearest_centre

    assigned = nearest_centre(df, centres, features_col, "cluster")
    vector = array_to_vector(as_array(assigned, features_col))
    return assigned.groupBy("cluster").agg(
        vector_to_array(Summarizer.mean(vector)).alias("centre"))


def _hash_share(column: str, *salt) -> Column:
    """A number in [0, 1) that depends on the id and the salt alone."""
    text = F.concat_ws(":", *[F.lit(str(x)) for x in salt], F.col(column).cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / float(16**13)


def kmeans_candidates(points: DataFrame, id_col: str, features_col: str, k: int, seed: int,
                      rounds: int = 2) -> list[tuple[object, list[float], int]]:
    """M8, k-means|| oversampling: ``(id, point, weight)``.

    The first candidate has the smallest hash of its id.  Each round takes every point
    with probability ``2 k d² / Σ d²``, d to the nearest candidate so far; the draw is a
    hash of seed, round and id, so neither the layout of the data nor a recomputed task
    changes it.  A candidate weighs the points nearest to it.  About ``2 k`` rows a
    round reach the driver."""
    from ..streaming.online_kmeans import as_array, nearest_centre, squared_distances

    p = points.select(F.col(id_col).alias("id"), as_array(points, features_col).alias("x")).where("id is not null")
    first = p.select(_hash_share("id", seed, 0).alias("u"), "id", "x").orderBy("u", "id").limit(1).collect()
    found = [(r.id, list(r.x)) for r in first]
    for number in range(1, rounds + 1) if found else ():
        away = p.withColumn("d", F.array_min(squared_distances(F.col("x"), [x for _, x in found])))
        total = away.agg(F.sum("d")).first()[0]
        if not total:
            break
        taken = away.where(_hash_share("id", seed, number) * total < 2.0 * k * F.col("d")).select("id", "x").collect()
        found += sorted((r.id, list(r.x)) for r in taken)
    if not found:
        return []
    weights = dict(map(tuple, nearest_centre(p, [x for _, x in found], "x", "c").groupBy("c").count().collect()))
    return [(i, x, weights.get(j, 0)) for j, (i, x) in enumerate(found)]


def recluster(candidates, k: int, seed: int) -> np.ndarray:
    """``k`` seeds from weighted candidates: k-means++ draws, then Lloyd steps, on the
    driver (the candidates are a few tens of rows)."""
    x = np.array([c for _, c, _ in candidates], float)
    w = np.array([n for *_, n in candidates], float)
    rng = np.random.RandomState(seed)
    centres = x[[int(w.argmax())]]
    while len(centres) < min(k, len(np.unique(x, axis=0))):
        d = ((x[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1) * np.maximum(w, 1e-9)
        centres = np.vstack((centres, x[np.searchsorted(np.cumsum(d), rng.rand() * d.sum(), "right")]))
    for _ in range(30):
        near = ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.stack([np.average(x[near == j], axis=0, weights=w[near == j]) if w[near == j].sum() else c
                            for j, c in enumerate(centres)])
    return centres


def seeded_kmeans(points: DataFrame, id_col: str, features_col: str, k: int, seed: int,
                  max_iter: int = 20) -> np.ndarray:
    """M8 with seeds that do not depend on the layout: candidates, reclustering, Lloyd steps."""
    centres = recluster(kmeans_candidates(points, id_col, features_col, k, seed), k, seed)
    for _ in range(max_iter):
        moved = centres.copy()
        for r in kmeans_step(points, centres, features_col).collect():
            moved[r.cluster] = r.centre
        if np.abs(moved - centres).max() < 1e-9:
            break
        centres = moved
    return centres


def standardise(vectors: DataFrame, input_col: str = "features") -> tuple[object, DataFrame]:
    """M4 on its own: the fitted scaler and ``(patient_id, scaled)``."""
    model = StandardScaler(inputCol=input_col, outputCol="scaled", withMean=True,
                           withStd=True).fit(vectors)
    return model, model.transform(vectors).select("patient_id", "scaled")


def long_projection(long: DataFrame, projection: Projection) -> DataFrame:
    """The same projection from the long form, ``(patient_id, component, value)``: the
    stored entries times their feature's row of components, less the offset.  The
    fitted parameters (vocabulary × k) are broadcast after a size check."""
    spark = long.sparkSession
    rows = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(projection.weights)],
                                 "idx long, w array<double>")
    offset = F.array(*[F.lit(float(x)) for x in projection.offset])
    k = len(projection.offset)
    sums = long.join(broadcast_if_small(rows), "idx").groupBy("patient_id").agg(
        F.array(*[F.sum(F.col("value") * F.col("w")[j]) for j in range(k)]).alias("s"))
    return sums.select("patient_id", F.zip_with("s", offset, lambda a, b: a - b).alias("pca"))


# The run report's wording, per arm and per algorithm.
ARM_TITLES = {"all": "All feature", "filtered": "Filtered feature"}
ALGORITHM_TITLES = {"kmeans": "kMeans", "gmm": "GMM", "streaming_kmeans": "StreamingKmeans"}


def report_lines(report: DataFrame) -> list[str]:
    """The six printed purities (five decimals) from the 6-row report."""
    order = {(a, g): i for i, (a, g) in enumerate(
        (a, g) for a in ARM_TITLES for g in ALGORITHM_TITLES)}
    rows = sorted(report.collect(), key=lambda r: order[(r.arm, r.algorithm)])
    counts = {r.arm: r.n for r in rows}
    lines = [f"[{ARM_TITLES[a]}] patients: {n}" for a, n in counts.items()]
    return lines + [
        f"[{ARM_TITLES[r.arm]}] purity of {ALGORITHM_TITLES[r.algorithm]} is: "
        + ("null" if r.purity is None else f"{r.purity:.5f}")
        for r in rows
    ]
