"""Online (streaming) k-means: nearest-centre assignment (M11) and the
discounted centre update (M10), batch and Structured Streaming forms.

Per batch, with centres ``c_k`` and weights ``w_k``:

1. assign every point to its nearest centre (first one on ties);
2. per cluster, the point count ``n_k`` and coordinate sum ``s_k``;
3. ``w_k *= discount`` (decay per batch, or decay ** points for ``points``);
4. for ``n_k > 0``: ``w_k += n_k``, ``λ = n_k / max(w_k, 1e-16)``,
   ``c_k = (1-λ) c_k + (λ/n_k) s_k``;
5. if the smallest weight is below 1e-8 × the largest, the largest cluster is
   split in two: both take the mean weight, centres nudged by
   ±1e-14·max(|x|, 1).

Steps 1-2 are one Spark job: assignment is a projection over the centres held
as literals (k × d numbers, never a join), and the sums are a grouped
aggregate with map-side combine, so a cluster holding most points is merged
per task before the shuffle.  Only the k × d result reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import remove_path

TIME_UNITS = ("batches", "points")


def as_array(df: DataFrame, features_col: str) -> Column:
    """The feature column as ``array<double>`` (vectors or numeric arrays)."""
    dt = df.schema[features_col].dataType
    if isinstance(dt, VectorUDT):
        return vector_to_array(F.col(features_col))
    return F.col(features_col).cast("array<double>")


def _centres_literal(centres: np.ndarray) -> Column:
    return F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in centres])


def squared_distances(arr: Column, centres: np.ndarray) -> Column:
    """Array of squared Euclidean distances from ``arr`` to every centre."""
    return F.transform(
        _centres_literal(centres),
        lambda c: F.aggregate(
            F.zip_with(arr, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x
        ),
    )


def nearest_centre(df: DataFrame, centres: np.ndarray, features_col: str = "features",
                   out: str = "cluster") -> DataFrame:
    """Add the index of the nearest centre (lowest index on ties)."""
    d = squared_distances(as_array(df, features_col), np.asarray(centres, dtype=float))
    # the least (distance, index): the distances are evaluated once
    nearest = F.array_min(F.transform(d, lambda x, i: F.struct(x.alias("d"), i.alias("i"))))
    return df.withColumn(out, nearest["i"].cast("int"))


def cluster_stats(assigned: DataFrame, features_col: str, dim: int,
                  cluster_col: str = "cluster") -> dict[int, tuple[int, np.ndarray]]:
    """Per-cluster point count and coordinate sum: one grouped aggregate, k rows
    collected."""
    vector = array_to_vector(as_array(assigned, features_col))
    rows = (
        assigned.select(F.col(cluster_col).alias("_c"), vector.alias("_x"))
        .groupBy("_c").agg(Summarizer.metrics("sum", "count").summary(F.col("_x")).alias("_s"))
        .select("_c", "_s.sum", "_s.count").collect()
    )
    return {int(r["_c"]): (int(r["count"]), r["sum"].toArray()) for r in rows}


def apply_update(centres: np.ndarray, weights: np.ndarray,
                 stats: dict[int, tuple[int, np.ndarray]], decay: float = 1.0,
                 time_unit: str = "batches") -> tuple[np.ndarray, np.ndarray]:
    """Steps 3-5 on the k × d driver state; returns new arrays."""
    if time_unit not in TIME_UNITS:
        raise ValueError(f"time_unit must be one of {TIME_UNITS}")
    c = np.array(centres, dtype=float, copy=True)
    w = np.array(weights, dtype=float, copy=True)
    if time_unit == "batches":
        discount = decay
    else:
        discount = decay ** sum(n for n, _ in stats.values())
    w *= discount
    for k, (n, s) in stats.items():
        if n <= 0:
            continue
        w[k] += n
        lam = n / max(w[k], 1e-16)
        c[k] = c[k] * (1.0 - lam) + s * (lam / n)
    largest, smallest = int(np.argmax(w)), int(np.argmin(w))
    if w[smallest] < 1e-8 * w[largest]:
        mean_w = (w[largest] + w[smallest]) / 2.0
        w[largest] = w[smallest] = mean_w
        x = c[largest].copy()
        p = 1e-14 * np.maximum(np.abs(x), 1.0)
        c[largest] = x + p
        c[smallest] = x - p
    return c, w


#: Versions of the state that are kept.
RETAINED = 2


@dataclass
class OnlineKMeansState:
    centres: np.ndarray
    weights: np.ndarray
    batch_id: int = -1


class OnlineKMeans:
    """Streaming k-means with an explicit, versioned state.

    ``update`` / ``predict`` work on any DataFrame (the batch form).
    ``foreach_batch`` is the Structured Streaming sink: each micro-batch is one
    update, and the state is written per batch id to ``state_dir`` (a shared
    folder), so a micro-batch replayed after a failure is ignored and a
    restarted query resumes from the last applied batch.
    """

    def __init__(self, k: int, decay: float = 1.0, time_unit: str = "batches",
                 features_col: str = "features", state_dir: str | None = None):
        if time_unit not in TIME_UNITS:
            raise ValueError(f"time_unit must be one of {TIME_UNITS}")
        self.k, self.decay, self.time_unit = k, decay, time_unit
        self.features_col, self.state_dir = features_col, state_dir
        self.state: OnlineKMeansState | None = None
        self.stream: str | None = None
        #: Versions in ``state_dir``, as far as this run knows; listed once per run.
        self._versions: list[int] = []

    # -- initial state ------------------------------------------------------
    def set_centres(self, centres, weights) -> OnlineKMeans:
        c = np.asarray(centres, dtype=float)
        w = np.asarray(weights, dtype=float)
        if c.shape[0] != self.k or w.shape != (self.k,):
            raise ValueError("need k centres and k weights")
        self.state = OnlineKMeansState(c, w)
        return self

    def set_random_centres(self, dim: int, weight: float, seed: int) -> OnlineKMeans:
        """Standard-normal centres from ``numpy.random.RandomState(seed)``, the
        same draw PySpark's streaming k-means makes."""
        rng = np.random.RandomState(seed)
        return self.set_centres(rng.randn(self.k, dim), np.full(self.k, float(weight)))

    # -- batch form ---------------------------------------------------------
    def update(self, df: DataFrame) -> OnlineKMeans:
        s = self._require_state()
        assigned = nearest_centre(df, s.centres, self.features_col, "_cluster")
        stats = cluster_stats(assigned, self.features_col, s.centres.shape[1], "_cluster")
        s.centres, s.weights = apply_update(s.centres, s.weights, stats, self.decay,
                                            self.time_unit)
        return self

    def predict(self, df: DataFrame, out: str = "cluster") -> DataFrame:
        return nearest_centre(df, self._require_state().centres, self.features_col, out)

    # -- streaming form -----------------------------------------------------
    def foreach_batch(self, batch_df: DataFrame, batch_id: int) -> None:
        if self.state_dir is not None and not self._versions:
            self._load_latest(batch_df.sparkSession)
        s = self._require_state()
        if batch_id <= s.batch_id:
            return  # replayed micro-batch: already applied
        self.update(batch_df)
        s.batch_id = batch_id
        if self.state_dir is not None:
            self._save(batch_df.sparkSession)

    def run_stream(self, stream_df: DataFrame, checkpoint_location: str, trigger=None):
        """Start the update stream; ``trigger`` defaults to ``availableNow``.

        The state belongs to the stream of ``checkpoint_location``: batch numbers
        say what was applied only within one stream, so another stream fails on it."""
        self.stream = checkpoint_location.rstrip("/")
        self._versions = []
        writer = (
            stream_df.writeStream.foreachBatch(self.foreach_batch)
            .option("checkpointLocation", checkpoint_location)
        )
        writer = writer.trigger(**(trigger or {"availableNow": True}))
        return writer.start()

    # -- state persistence (Spark I/O, so any shared file system works) ----
    _STATE_SCHEMA = T.StructType([
        T.StructField("cluster", T.IntegerType()),
        T.StructField("weight", T.DoubleType()),
        T.StructField("centre", T.ArrayType(T.DoubleType())),
        T.StructField("batch_id", T.LongType()),
        T.StructField("stream", T.StringType()),
    ])

    def _save(self, spark: SparkSession) -> None:
        s = self._require_state()
        rows = [(k, float(s.weights[k]), [float(x) for x in s.centres[k]], int(s.batch_id), self.stream)
                for k in range(self.k)]
        (spark.createDataFrame(rows, self._STATE_SCHEMA).coalesce(1).write.mode("overwrite")
         .parquet(f"{self.state_dir}/version={s.batch_id}"))
        # a replay can only be of the last batch: its version says that it was applied, the
        # one before is what it would be applied to
        self._versions.append(s.batch_id)
        for old in self._versions[:-RETAINED]:
            remove_path(spark, f"{self.state_dir}/version={old}")
        self._versions = self._versions[-RETAINED:]

    def _committed_versions(self, spark: SparkSession) -> list[int]:
        """Batch ids whose state write finished (``_SUCCESS`` is written last),
        listed through the Hadoop file system of ``state_dir``."""
        jvm = spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.state_dir)
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        out = []
        for st in fs.listStatus(root):
            name = st.getPath().getName()
            if name.startswith("version=") and fs.exists(
                    jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name.split("=", 1)[1]))
        return sorted(out)

    def _load_latest(self, spark: SparkSession) -> None:
        versions = self._committed_versions(spark)
        self._versions = versions
        if not versions:
            return
        latest = versions[-1]
        if self.state is not None and latest <= self.state.batch_id:
            return
        rows = sorted(
            spark.read.schema(self._STATE_SCHEMA).parquet(f"{self.state_dir}/version={latest}")
            .collect(),
            key=lambda r: r.cluster,
        )
        if rows[0].stream != self.stream:
            raise ValueError(f"{self.state_dir} holds the state of stream {rows[0].stream}, not of {self.stream}")
        self.state = OnlineKMeansState(
            np.array([r.centre for r in rows], dtype=float),
            np.array([r.weight for r in rows], dtype=float),
            int(latest),
        )

    def _require_state(self) -> OnlineKMeansState:
        if self.state is None:
            raise ValueError("set centres first (set_centres or set_random_centres)")
        return self.state
