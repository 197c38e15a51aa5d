"""Online k-means as a Structured Streaming sink with replay-safe state."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from phenoscope.streaming.online_kmeans import OnlineKMeans

CENTRES = np.array([[4.0, 4.0], [-4.0, -4.0], [0.0, 0.5]])


def _frame(spark, seed):
    rng = np.random.RandomState(seed)
    pts = np.vstack([rng.randn(20, 2) + 5, rng.randn(20, 2) - 5])
    return spark.createDataFrame([(Vectors.dense(p.tolist()),) for p in pts], ["features"])


def test_replayed_batch_is_ignored(spark):
    state_dir = tempfile.mkdtemp()
    df = _frame(spark, 0)
    m = OnlineKMeans(3, state_dir=state_dir).set_centres(CENTRES, [0.5] * 3)
    m.foreach_batch(df, 0)
    after_first = m.state.centres.copy()
    m.foreach_batch(df, 0)  # replay of batch 0
    np.testing.assert_array_equal(m.state.centres, after_first)
    # a restarted process resumes from the saved state and also skips batch 0
    restarted = OnlineKMeans(3, state_dir=state_dir).set_centres(CENTRES, [0.5] * 3)
    restarted.foreach_batch(df, 0)
    np.testing.assert_array_equal(restarted.state.centres, after_first)
    assert restarted.state.batch_id == 0
    restarted.foreach_batch(_frame(spark, 1), 1)
    assert restarted.state.batch_id == 1


def test_stream_of_files_equals_batch_updates(spark):
    src = tempfile.mkdtemp()
    frames = [_frame(spark, s) for s in (0, 1)]
    batch = OnlineKMeans(3).set_centres(CENTRES, [0.5] * 3)
    for i, f in enumerate(frames):
        f.coalesce(1).write.parquet(os.path.join(src, f"part{i}"))
        batch.update(f)
    schema = spark.read.parquet(os.path.join(src, "part0")).schema
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    online = OnlineKMeans(3, state_dir=tempfile.mkdtemp()).set_centres(CENTRES, [0.5] * 3)
    q = online.run_stream(stream, tempfile.mkdtemp())
    q.awaitTermination(120)
    assert online.state.batch_id == 1
    np.testing.assert_allclose(online.state.centres, batch.state.centres, rtol=1e-12)


def test_unfinished_state_write_is_ignored(spark):
    state_dir = tempfile.mkdtemp()
    df = _frame(spark, 0)
    m = OnlineKMeans(3, state_dir=state_dir).set_centres(CENTRES, [0.5] * 3)
    m.foreach_batch(df, 0)
    # a crash while writing batch 1's state leaves a folder without _SUCCESS
    os.makedirs(os.path.join(state_dir, "version=1"))
    restarted = OnlineKMeans(3, state_dir=state_dir).set_centres(CENTRES, [0.5] * 3)
    restarted.foreach_batch(_frame(spark, 1), 1)  # batch 1 is applied, not skipped
    assert restarted.state.batch_id == 1
    assert not np.array_equal(restarted.state.centres, m.state.centres)


def test_state_of_another_stream_is_refused(spark):
    src, state_dir = tempfile.mkdtemp(), tempfile.mkdtemp()
    _frame(spark, 0).coalesce(1).write.mode("overwrite").parquet(src)
    schema = spark.read.parquet(src).schema

    def run():
        online = OnlineKMeans(3, state_dir=state_dir).set_centres(CENTRES, [0.5] * 3)
        online.run_stream(spark.readStream.schema(schema).parquet(src), tempfile.mkdtemp()).awaitTermination(120)

    run()
    with pytest.raises(Exception, match="holds the state of stream"):
        run()  # a new checkpoint is a new stream: its batch 0 must not pass for applied


@pytest.mark.parametrize("files", [1, 4])
def test_registered_stream_does_not_depend_on_file_layout(spark, files):
    from phenoscope.plans.queries import QUERIES

    sf, d = "/root/testdata/sf0.001", tempfile.mkdtemp()
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    table.repartition(files).write.parquet(f"{d}/embeddings.parquet")
    got, batch = (sorted(map(tuple, QUERIES[q](spark, d).collect()))
                  for q in ("online_kmeans_stream", "online_kmeans_update"))
    assert [g[:2] for g in got] == [b[:2] for b in batch]
    np.testing.assert_allclose([g[2:] for g in got], [b[2:] for b in batch], atol=2e-6)


def test_twenty_batches_leave_two_versions_and_survive_a_replay(spark, tmp_path):
    state = str(tmp_path / "state")
    rows = [spark.createDataFrame([([float(b), 1.0],), ([-float(b), -1.0],)], "features array<double>") for b in range(20)]

    def fresh():
        m = OnlineKMeans(2, state_dir=state).set_centres([[1.0, 1.0], [-1.0, -1.0]], [0.5, 0.5])
        m.stream = "s"
        return m

    m = fresh()
    for b in range(12):
        m.foreach_batch(rows[b], b)
    m = fresh()  # a restart
    for b in range(11, 20):  # the last batch comes again
        m.foreach_batch(rows[b], b)
    assert sorted(p.name for p in (tmp_path / "state").iterdir()) == ["version=18", "version=19"]
    want = OnlineKMeans(2).set_centres([[1.0, 1.0], [-1.0, -1.0]], [0.5, 0.5])
    for b in range(20):
        want.update(rows[b])
    assert m.state.centres == pytest.approx(want.state.centres)
    again = fresh()
    again.foreach_batch(rows[19], 19)
    assert again.state.centres == pytest.approx(m.state.centres) and again.state.batch_id == 19
