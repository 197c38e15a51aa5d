"""Registered queries: one per operator group of the inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole tables
(fits, and frames that several steps read, run when the query is built).  Column names match the DuckDB oracle in ``oracle.py``; instants are
returned as epoch milliseconds and averaged doubles are rounded to 6 places
(summation order differs between engines).
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cohort, features, metrics
from ..operators.extract import with_epoch_ms
from ..sources.criteria import candidate_terms, criteria_frame, lab_rules_frame
from ..session import reliable_checkpoint, scratch_scope, stored
from .context import Events, load_events, stored_events

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

ROUND = 6
SEED = 6250


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _r(c):
    return F.round(F.col(c) if isinstance(c, str) else c, ROUND)


# --- extraction (P1-P8, J1) -------------------------------------------------

@query
def lab_extract(spark, sf_dir):
    return with_epoch_ms(load_events(spark, sf_dir).lab)


@query
def med_extract(spark, sf_dir):
    return with_epoch_ms(load_events(spark, sf_dir).med)


@query
def dx_extract(spark, sf_dir):
    return with_epoch_ms(load_events(spark, sf_dir).dx)


# --- cohort (C1-C13, U2, U3, A4, P9-P12) ------------------------------------

@query
def patient_spine(spark, sf_dir):
    ev = load_events(spark, sf_dir)
    return cohort.patient_spine(ev.dx, ev.med, ev.lab)


@query
def code_set_members(spark, sf_dir):
    ev = load_events(spark, sf_dir)
    return cohort.code_set_members(ev.dx, ev.med, criteria_frame(spark, "reference"))


@query
def code_set_members_published(spark, sf_dir):
    ev = load_events(spark, sf_dir)
    return cohort.code_set_members(ev.dx, ev.med, criteria_frame(spark, "published"))


@query
def code_set_members_file(spark, sf_dir):
    """S5 from files: the published sets written as criteria files (code, description)
    and read back."""
    from ..session import scratch_path
    from ..sources.criteria import read_criteria, write_criteria

    root = scratch_path(spark, "criteria")
    write_criteria(spark, "published", root)
    ev = load_events(spark, sf_dir)
    return cohort.code_set_members(ev.dx, ev.med, read_criteria(spark, root))


@query
def dx_prefix_members(spark, sf_dir):
    return cohort.dx_prefix_patients(load_events(spark, sf_dir).dx, "250")


@query
def abnormal_labs(spark, sf_dir):
    return cohort.abnormal_lab_patients(load_events(spark, sf_dir).lab, lab_rules_frame(spark))


@query
def first_drug_dates(spark, sf_dir):
    d = cohort.first_drug_orders(load_events(spark, sf_dir).med)
    return d.select(
        "patient_id",
        F.unix_millis("first_t1_med").alias("first_t1_ms"),
        F.unix_millis("first_t2_med").alias("first_t2_ms"),
    )


@query
def patients_without_t1dx(spark, sf_dir):
    ev = load_events(spark, sf_dir)
    return cohort.patients_without_t1_dx(ev.dx, ev.med, ev.lab)


@query
def patients_with_both_drugs(spark, sf_dir):
    return cohort.patients_with_both_drugs(load_events(spark, sf_dir).med)


def _paths(spark, sf_dir, profile="reference"):
    ev = load_events(spark, sf_dir)
    flags = cohort.patient_flags(ev.dx, ev.med, ev.lab, profile)
    return cohort.case_path_columns(flags).withColumn("label", cohort.label_column(profile))


@query
def case_path_1(spark, sf_dir):
    return _paths(spark, sf_dir).where("case_path_1").select("patient_id")


@query
def case_path_2(spark, sf_dir):
    return _paths(spark, sf_dir).where("case_path_2").select("patient_id")


@query
def case_path_3(spark, sf_dir):
    return _paths(spark, sf_dir).where("case_path_3").select("patient_id")


@query
def cases(spark, sf_dir):
    return _paths(spark, sf_dir).where(F.col("label") == cohort.CASE).select("patient_id")


@query
def glucose_tested(spark, sf_dir):
    return cohort.glucose_tested(load_events(spark, sf_dir).lab)


@query
def controls(spark, sf_dir):
    return _paths(spark, sf_dir).where(F.col("label") == cohort.CONTROL).select("patient_id")


@query
def controls_published(spark, sf_dir):
    return (
        _paths(spark, sf_dir, "published")
        .where(F.col("label") == cohort.CONTROL).select("patient_id")
    )


@query
def others(spark, sf_dir):
    return _paths(spark, sf_dir).where(F.col("label") == cohort.OTHER).select("patient_id")


@query
def phenotype_labels(spark, sf_dir):
    ev = load_events(spark, sf_dir)
    return cohort.phenotype_labels(ev.dx, ev.med, ev.lab, "reference")


@query
def phenotype_labels_published(spark, sf_dir):
    ev = load_events(spark, sf_dir)
    return cohort.phenotype_labels(ev.dx, ev.med, ev.lab, "published")


@query
def phenotype_label_counts(spark, sf_dir):
    return phenotype_labels(spark, sf_dir).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


# --- feature tuples (A1-A3, A1f-A3f, M1, M2) --------------------------------

def _tuples_out(df):
    return df.select("patient_id", "feature", _r("value").alias("value"))


@query
def dx_counts(spark, sf_dir):
    return _tuples_out(features.diagnostic_features(load_events(spark, sf_dir).dx))


@query
def med_counts(spark, sf_dir):
    return _tuples_out(features.medication_features(load_events(spark, sf_dir).med))


@query
def lab_means(spark, sf_dir):
    return _tuples_out(features.lab_features(load_events(spark, sf_dir).lab))


@query
def dx_counts_filtered(spark, sf_dir):
    dx = load_events(spark, sf_dir).dx
    return _tuples_out(features.diagnostic_features(dx, candidate_terms("dx")))


@query
def med_counts_filtered(spark, sf_dir):
    med = load_events(spark, sf_dir).med
    return _tuples_out(features.medication_features(med, candidate_terms("med")))


@query
def med_counts_filtered_terms(spark, sf_dir):
    """P13 with a term frame: the candidates come from a term file."""
    from ..session import scratch_path
    from ..sources.criteria import candidate_frame
    from ..sources.terms import read_term_set, write_term_set

    path = scratch_path(spark, "med-filter")
    write_term_set(candidate_frame(spark, "med"), "term", path)
    med = load_events(spark, sf_dir).med
    return _tuples_out(features.medication_features(med, read_term_set(spark, path)))


@query
def lab_means_filtered(spark, sf_dir):
    lab = load_events(spark, sf_dir).lab
    return _tuples_out(features.lab_features(lab, candidate_terms("lab")))


def _all_tuples(spark, sf_dir, filtered=False, ev: Events | None = None):
    ev = ev or load_events(spark, sf_dir)
    if not filtered:
        return features.feature_tuples(ev.dx, ev.med, ev.lab)
    return features.feature_tuples(
        ev.dx, ev.med, ev.lab,
        dx_candidates=candidate_terms("dx"),
        med_candidates=candidate_terms("med"),
        lab_candidates=candidate_terms("lab"),
    )


@query
def feature_tuples(spark, sf_dir):
    return _tuples_out(_all_tuples(spark, sf_dir))


@query
def feature_tuples_filtered(spark, sf_dir):
    return _tuples_out(_all_tuples(spark, sf_dir, filtered=True))


# --- dictionary and matrix (A10, J6, A5, M3) --------------------------------

def _stored_tuples(spark, sf_dir):
    """Tuples written once to the checkpoint folder: the dictionary and the
    matrix join both read them (aggregated, far smaller than the events)."""
    return reliable_checkpoint(_all_tuples(spark, sf_dir))


@query
def feature_dictionary(spark, sf_dir):
    return features.feature_dictionary(_all_tuples(spark, sf_dir))


@query
def feature_matrix_long(spark, sf_dir):
    t = _stored_tuples(spark, sf_dir)
    long = features.feature_matrix_long(t, features.feature_dictionary(t))
    return long.select("patient_id", "idx", _r("value").alias("value"))


@query
def feature_vectors(spark, sf_dir):
    from .learn import patient_matrix

    v, size = patient_matrix(_stored_tuples(spark, sf_dir))
    # the stored struct of a sparse vector, without making it dense
    values = F.unwrap_udt("features")["values"]
    return v.select(
        "patient_id",
        F.lit(size).cast("long").alias("size"),
        F.size(F.filter(values, lambda x: x != 0.0)).cast("long").alias("nnz"),
        _r(F.aggregate(values, F.lit(0.0), lambda a, x: a + x)).alias("total"),
    )


# --- purity (A7-A9, J4, M12) ------------------------------------------------

@query
def contingency(spark, sf_dir):
    # fixed assignments from data: an order's status as the cluster, its
    # priority as the class
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return metrics.contingency(o, "o_orderstatus", "o_orderpriority")


@query
def purity_by_assignment(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    p = metrics.purity(o, "o_orderstatus", "o_orderpriority")
    return p.select("n", _r("purity").alias("purity"))


@query
def purity_vs_phenotype(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").cast("string").alias("patient_id"),
        F.col("c_mktsegment").alias("cluster"),
    )
    labels = phenotype_labels(spark, sf_dir)
    p = metrics.purity(metrics.assignments_with_labels(c, labels), "cluster", "label")
    return p.select("n", _r("purity").alias("purity"))


# --- sources and sinks round trips (S1-S4, S6, S7) --------------------------

def _staged_csv(spark, sf_dir, stems):
    """Write raw extracts as headed CSV under the shared scratch folder and read them
    back as views named after their paths.  As in real extracts, a folder's files differ
    in column order, one has a further column, and some lines are malformed: of each row
    whose first key ends in 0 there is a copy with a comma too many."""
    from ..session import scratch_path
    from ..sources.csv import RAW_COLUMNS, read_csv_table, write_csv_table
    from .learn import run_concurrently

    raw = load_events(spark, sf_dir).raw
    root = scratch_path(spark, "raw-csv")

    def stage(stem):
        path = f"{root}/{stem}.csv"
        names = RAW_COLUMNS[stem]
        rows = stored(raw[stem], stem)  # three writes read them
        half = F.pmod(F.xxhash64(*names), F.lit(2))
        backward = [F.col(c) for c in reversed(names)]
        write_csv_table(rows.where(half == 0).select(
            *backward[:1], F.lit("x, y").alias("Remark"), *backward[1:]), path)
        write_csv_table(rows.where(half == 1).select(*names), path, mode="append")
        broken = rows.where(F.col(names[0]).endswith("0")).select(F.lit("x,y").alias(names[0]), *names[1:])
        broken.write.mode("append").option("header", "true").option("quote", "").csv(path)
        return read_csv_table(spark, path, columns=names)

    return dict(zip(stems, run_concurrently(spark, [functools.partial(stage, s) for s in stems])))


@query
def csv_rejected_rows(spark, sf_dir):
    """Malformed lines are counted, not lost silently."""
    parts = [spark.table(f"{stem}_rejected").agg(F.count("*").alias("n")).select(F.lit(stem).alias("extract"), "n")
             for stem in _staged_csv(spark, sf_dir, ["lab_results_INPUT", "medication_orders_INPUT",
                                                     "encounter_INPUT", "encounter_dx_INPUT"])]
    return functools.reduce(DataFrame.unionByName, parts)


@query
def csv_lab_roundtrip(spark, sf_dir):
    from ..operators.extract import extract_labs

    _staged_csv(spark, sf_dir, ["lab_results_INPUT"])
    return with_epoch_ms(extract_labs(spark.table("lab_results_INPUT")))


@query
def csv_med_roundtrip(spark, sf_dir):
    from ..operators.extract import extract_medications

    _staged_csv(spark, sf_dir, ["medication_orders_INPUT"])
    return with_epoch_ms(extract_medications(spark.table("medication_orders_INPUT")))


@query
def csv_dx_roundtrip(spark, sf_dir):
    from ..operators.extract import extract_diagnoses

    _staged_csv(spark, sf_dir, ["encounter_INPUT", "encounter_dx_INPUT"])
    return with_epoch_ms(
        extract_diagnoses(spark.table("encounter_INPUT"), spark.table("encounter_dx_INPUT"))
    )


@query
def term_set(spark, sf_dir):
    from ..session import scratch_path
    from ..sources.terms import read_term_set, write_term_set

    raw = load_events(spark, sf_dir).raw["medication_orders_INPUT"]
    path = scratch_path(spark, "terms")
    write_term_set(raw.select("Drug_Name").distinct(), "Drug_Name", path)
    return read_term_set(spark, path)


@query
def label_sink_roundtrip(spark, sf_dir):
    from ..session import scratch_path
    from ..sources.sinks import read_labels, write_labels

    path = scratch_path(spark, "labels")
    write_labels(phenotype_labels(spark, sf_dir), path)
    return read_labels(spark, path)


@query
def feature_sink_roundtrip(spark, sf_dir):
    from ..session import scratch_path
    from ..sources.sinks import read_features, write_features

    path = scratch_path(spark, "features")
    write_features(_all_tuples(spark, sf_dir), path)
    return _tuples_out(read_features(spark, path))


# --- scaler moments (A11) ---------------------------------------------------

@query
def feature_moments(spark, sf_dir):
    from .learn import feature_moments as moments

    t = _stored_tuples(spark, sf_dir)
    long = reliable_checkpoint(features.feature_matrix_long(t, features.feature_dictionary(t)))
    n_rows = long.select("patient_id").distinct().count()
    m = moments(long, n_rows)
    return m.select("idx", _r("mean").alias("mean"), _r("std").alias("std"))


# --- clustering on embeddings with fixed centres (M8 step, M10, M11) --------

def _embeddings(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return e.select("vec_id", F.col("embedding").cast("array<double>").alias("features"),
                    "label")


def _fixed_centres(e, k=3):
    """The k vectors with the lowest ids (a top-k; only k rows reach the driver)."""
    import numpy as np

    rows = e.orderBy("vec_id").limit(k).select("features").collect()
    return np.array([r.features for r in rows], dtype=float)


@query
def nearest_centre(spark, sf_dir):
    from ..streaming.online_kmeans import nearest_centre as assign

    e = _embeddings(spark, sf_dir)
    return assign(e, _fixed_centres(e)).select("vec_id", "cluster")


@query
def kmeans_one_step(spark, sf_dir):
    from .learn import kmeans_step

    e = _embeddings(spark, sf_dir)
    c = kmeans_step(e, _fixed_centres(e))
    return c.select("cluster", F.posexplode("centre").alias("dim", "value")).select(
        "cluster", "dim", _r("value").alias("value")
    )


@query
def kmeans_seeds(spark, sf_dir):
    """M8: the candidates of k-means|| in two rounds, and how many vectors each is next to."""
    from .learn import kmeans_candidates

    rows = kmeans_candidates(_embeddings(spark, sf_dir), "vec_id", "features", 3, SEED)
    return spark.createDataFrame([(i, n) for i, _, n in rows], "vec_id long, weight long")


@query
def online_kmeans_update(spark, sf_dir):
    from ..streaming.online_kmeans import OnlineKMeans

    e = _embeddings(spark, sf_dir)
    centres = _fixed_centres(e)
    m = OnlineKMeans(3, decay=1.0, time_unit="batches").set_centres(centres, [0.5] * 3).update(e)
    rows = [
        (k, j, float(round(m.state.centres[k][j], ROUND)), float(m.state.weights[k]))
        for k in range(3) for j in range(centres.shape[1])
    ]
    return spark.createDataFrame(rows, "cluster int, dim int, value double, weight double")


@query
def online_kmeans_stream(spark, sf_dir):
    """M10 as Structured Streaming: the embeddings file is read as a stream and
    every micro-batch updates the model through ``foreachBatch``; the state is
    versioned by batch id in the shared checkpoint folder.  ``availableNow`` takes
    all files as one micro-batch, however many there are, so the result equals
    the batch update."""
    from ..session import scratch_path
    from ..streaming.online_kmeans import OnlineKMeans

    e = _embeddings(spark, sf_dir)
    centres = _fixed_centres(e)
    schema = spark.read.parquet(f"{sf_dir}/embeddings.parquet").schema
    # a file stream watches a folder; the glob selects the one table file in it
    stream = (spark.readStream.schema(schema)
              .parquet(f"{sf_dir}/embedding[s].parquet"))
    stream = stream.select(F.col("embedding").cast("array<double>").alias("features"))
    m = OnlineKMeans(3, decay=1.0, time_unit="batches",
                     state_dir=scratch_path(spark, "online-kmeans-state"))
    m.set_centres(centres, [0.5] * 3)
    q = m.run_stream(stream, scratch_path(spark, "online-kmeans-stream"))
    q.awaitTermination()
    rows = [
        (k, j, float(round(m.state.centres[k][j], ROUND)), float(m.state.weights[k]))
        for k in range(3) for j in range(centres.shape[1])
    ]
    return spark.createDataFrame(rows, "cluster int, dim int, value double, weight double")


@query
def online_kmeans_two_batches(spark, sf_dir):
    """M10 over two micro-batches: the vectors with an even id arrive, the stream runs
    and ends, the others arrive, and a second run resumes from its checkpoint and state."""
    from ..session import scratch_path
    from ..streaming.online_kmeans import OnlineKMeans

    e = _embeddings(spark, sf_dir)
    centres = _fixed_centres(e)
    source, state, checkpoint = (scratch_path(spark, f"online-kmeans-{n}") for n in ("source", "state", "runs"))
    for part in range(2):
        e.where(F.col("vec_id") % 2 == part).write.mode("append").parquet(source)
        m = OnlineKMeans(3, decay=1.0, time_unit="batches", state_dir=state).set_centres(centres, [0.5] * 3)
        m.run_stream(spark.readStream.schema(e.schema).parquet(source), checkpoint).awaitTermination()
    rows = [
        (k, j, float(round(m.state.centres[k][j], ROUND)), float(m.state.weights[k]))
        for k in range(3) for j in range(centres.shape[1])
    ]
    return spark.createDataFrame(rows, "cluster int, dim int, value double, weight double")


@query
def embedding_purity(spark, sf_dir):
    from ..streaming.online_kmeans import nearest_centre as assign

    e = _embeddings(spark, sf_dir)
    p = metrics.purity(assign(e, _fixed_centres(e)), "cluster", "label")
    return p.select("n", _r("purity").alias("purity"))


# --- patient clustering (M4-M9, M13, M14, S8): rows-only checks -------------

def _experiment(spark, sf_dir, algorithms):
    from .learn import ClusteringExperiment, patient_matrix

    vectors, width = patient_matrix(_stored_tuples(spark, sf_dir))
    return ClusteringExperiment().fit(vectors, width, algorithms)


@query
def pca_projection(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    exp = _experiment(spark, sf_dir, ())
    return exp.projected.select("patient_id", vector_to_array("pca").alias("pca"))


@query
def kmeans_assign(spark, sf_dir):
    return _experiment(spark, sf_dir, ("kmeans",)).assignments("kmeans")


@query
def gmm_assign(spark, sf_dir):
    return _experiment(spark, sf_dir, ("gmm",)).assignments("gmm")


@query
def online_kmeans_assign(spark, sf_dir):
    return _experiment(spark, sf_dir, ("streaming_kmeans",)).assignments("streaming_kmeans")


@query
def experiment_report(spark, sf_dir):
    from .learn import experiment_report as report

    # the report is collected, so the stored events need not outlive it
    with scratch_scope(spark):
        ev = stored_events(spark, sf_dir)
        labels = cohort.phenotype_labels(ev.dx, ev.med, ev.lab)
        return report(ev.dx, ev.med, ev.lab, labels)


# --- standardisation and the PCA covariance (M4, A12) -----------------------

@query
def standardised_values(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    from .learn import patient_matrix, standardise

    vectors, _ = patient_matrix(_stored_tuples(spark, sf_dir))
    _, scaled = standardise(vectors)
    return scaled.select("patient_id", F.posexplode(vector_to_array("scaled")).alias(
        "idx", "value")).select("patient_id", "idx", _r("value").alias("value"))


@query
def standardised_entries(spark, sf_dir):
    """M4 in sparse form: stored entries over their std, and (``patient_id`` null) the
    baseline of each feature."""
    from .learn import standardised_entries as sparse_form

    t = _stored_tuples(spark, sf_dir)
    long = reliable_checkpoint(features.feature_matrix_long(t, features.feature_dictionary(t)))
    entries, baseline = sparse_form(long, long.select("patient_id").distinct().count())
    rows = entries.unionByName(baseline.select(F.lit(None).cast("string").alias("patient_id"), "idx", "value"))
    return rows.select("patient_id", "idx", _r("value").alias("value"))


def _covariance(spark, sf_dir, in_tasks):
    from .learn import covariance_long

    t = _stored_tuples(spark, sf_dir)
    d = features.feature_dictionary(t)
    long = reliable_checkpoint(features.feature_matrix_long(t, d))
    cov = covariance_long(long, long.select("patient_id").distinct().count(), d.count(), in_tasks)
    return cov.select("i", "j", _r("value").alias("value"))


@query
def covariance_entries(spark, sf_dir):
    """A12 with JVM expressions alone."""
    return _covariance(spark, sf_dir, in_tasks=False)


@query
def covariance_in_tasks(spark, sf_dir):
    """A12 for wide patients: products summed inside the tasks."""
    return _covariance(spark, sf_dir, in_tasks=True)


# --- certificates of the fitted models (M4-M9, M13, M14, S8) ----------------
# A fit has no SQL twin, so these return what must hold of it over all rows: exact
# counts, and whether each property of the model holds.

@query
def kmeans_lloyd_steps(spark, sf_dir):
    """M8: three Lloyd steps from fixed centres."""
    from .learn import kmeans_step

    e = _embeddings(spark, sf_dir)
    centres = _fixed_centres(e)
    for _ in range(3):
        step = kmeans_step(e, centres)
        centres = [r.centre for r in sorted(step.collect(), key=lambda r: r.cluster)]
    rows = [(k, j, float(round(x, ROUND))) for k, c in enumerate(centres) for j, x in enumerate(c)]
    return spark.createDataFrame(rows, "cluster int, dim int, value double")


@query
def gmm_one_step(spark, sf_dir):
    """M9: one EM step from fixed means, unit covariances and equal weights: weights (i and
    j -1), means (j -1), covariances (i ≤ j), and the mean log-likelihood (component -1)."""
    import numpy as np

    from ..operators.linear import em_step

    e = _embeddings(spark, sf_dir)
    centres = _fixed_centres(e)
    k, d = centres.shape
    weights, means, covariances, likelihood = em_step(e, np.full(k, 1 / k), centres, np.stack([np.eye(d)] * k))
    rows = [(-1, -1, -1, likelihood / e.count())]
    for c in range(k):
        rows += [(c, -1, -1, weights[c]), *((c, i, -1, means[c][i]) for i in range(d)),
                 *((c, i, j, covariances[c][i, j]) for i in range(d) for j in range(i, d))]
    return spark.createDataFrame([(c, i, j, float(round(x, ROUND)) + 0.0) for c, i, j, x in rows],
                                 "component int, i int, j int, value double")


@query
def pca_certificate(spark, sf_dir):
    """M5, M6: orthonormal components, uncorrelated projections of falling variance; small
    residuals ‖CV - VΛ‖; the variance that ``pyspark.ml``'s PCA explains."""
    import numpy as np
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.stat import Correlation, Summarizer

    from .learn import ClusteringExperiment, patient_matrix

    vectors, width = patient_matrix(_stored_tuples(spark, sf_dir))
    exp = ClusteringExperiment().fit(vectors, width, ())
    p = exp.projection
    v = p.components
    k = v.shape[1]
    corr = Correlation.corr(exp.projected, "pca").first()[0].toArray()
    row = exp.projected.agg(Summarizer.metrics("count", "mean", "variance").summary(F.col("pca")).alias("s")).first().s
    var = row.variance.toArray()
    scaled = StandardScaler(inputCol="features", outputCol="s", withMean=False).fit(vectors).transform(vectors)
    plain = PCA(k=k, inputCol="s", outputCol="p").fit(scaled)
    share = var / float((p.std > 0).sum())
    return spark.createDataFrame([(
        int(row["count"]), k, bool(np.abs(v.T @ v - np.eye(k)).max() < 1e-8),
        bool(np.abs(corr - np.eye(k)).max() < 1e-6), bool(np.abs(row.mean.toArray()).max() < 1e-6),
        bool((np.diff(var) <= 1e-9 * var[0]).all()), bool(p.residuals.max() < 1e-8 * max(1.0, p.variances[0])),
        bool(np.abs(share - plain.explainedVariance.toArray()).max() < 1e-8))],
        "n long, k int, orthonormal boolean, uncorrelated boolean, centred boolean, falling boolean, "
        "settled boolean, explains_as_much boolean")


def _nearest_certificate(exp, algorithm, centres):
    """``n`` rows, each with the nearest centre, and whether a Lloyd step gains little."""
    from ..streaming.online_kmeans import as_array, squared_distances
    from ..streaming.online_kmeans import nearest_centre as assign
    from .learn import kmeans_step

    rows = assign(exp.projected, centres, "pca", "nearest").join(exp.assignments(algorithm), "patient_id")

    def cost(c):
        return exp.projected.agg(F.sum(F.array_min(squared_distances(as_array(exp.projected, "pca"), c)))).first()[0]

    moved = {r.cluster: r.centre for r in kmeans_step(exp.projected, centres, "pca").collect()}
    before, after = cost(centres), cost([moved.get(k, list(c)) for k, c in enumerate(centres)])
    return rows.agg(F.count("*").alias("n"), F.bool_and(F.col("nearest") == F.col("cluster")).alias("nearest"),
                    F.lit(bool(after <= before * (1 + 1e-9))).alias("step_gains"),
                    F.lit(bool(before - after <= 0.01 * before)).alias("settled"))


@query
def kmeans_certificate(spark, sf_dir):
    """M8: every patient is with the nearest centre, and another Lloyd step changes
    the cost by one percent at most."""
    exp = _experiment(spark, sf_dir, ("kmeans",))
    return _nearest_certificate(exp, "kmeans", [c.tolist() for c in exp.models["kmeans"].clusterCenters()])


@query
def online_kmeans_certificate(spark, sf_dir):
    """Every patient is with the nearest centre of the updated model."""
    exp = _experiment(spark, sf_dir, ("streaming_kmeans",))
    centres = exp.models["streaming_kmeans"].state.centres.tolist()
    return _nearest_certificate(exp, "streaming_kmeans", centres).select("n", "nearest", "step_gains")


def mixture_fits(points, weights, means, covariances, column="pca"):
    """Whether another EM step does not lower the likelihood of a mixture, and whether the
    mixture is likelier than the one Gaussian that fits the points best."""
    import numpy as np

    from ..operators.linear import em_step, mixture_sums
    from ..streaming.online_kmeans import as_array

    arrays = points.select(as_array(points, column).alias("x"))
    *step, own = em_step(arrays, weights, means, covariances, "x")
    after = mixture_sums(arrays, *step, "x")[-1]
    # one step from anywhere gives the moments of a single component
    d = len(means[0])
    *single, _ = em_step(arrays, [1.0], [np.zeros(d)], [np.eye(d)], "x")
    return bool(after >= own - 1e-9 * abs(own)), bool(own > mixture_sums(arrays, *single, "x")[-1])


@query
def gmm_certificate(spark, sf_dir):
    """M9: probabilities sum to 1, the label is the likeliest component, weights sum to 1;
    another EM step does not lower the likelihood, which is above a single Gaussian's."""
    from pyspark.ml.functions import vector_to_array

    exp = _experiment(spark, sf_dir, ("gmm",))
    model = exp.models["gmm"]
    p = vector_to_array("probability")
    rows = model.transform(exp.projected).select("cluster", p.alias("p"))
    total = F.aggregate("p", F.lit(0.0), lambda a, x: a + x)
    gaussians = [(g.mean.toArray(), g.cov.toArray()) for g in model.gaussians]
    gains, beats_one = mixture_fits(exp.projected, model.weights, [m for m, _ in gaussians],
                                    [c for _, c in gaussians])
    return rows.agg(
        F.count("*").alias("n"), F.bool_and(F.abs(total - 1.0) < 1e-9).alias("sums_to_one"),
        F.bool_and(F.get("p", F.col("cluster")) == F.array_max("p")).alias("likeliest"),
        F.lit(bool(abs(sum(model.weights) - 1.0) < 1e-9)).alias("weights_sum_to_one"),
        F.lit(gains).alias("step_gains"), F.lit(beats_one).alias("beats_one"))


@query
def experiment_certificate(spark, sf_dir):
    """Patients of each arm exactly, and each purity between the share of
    the arm's largest class and 1."""
    from .learn import experiment_report as report

    # labels, both arms' tuples and the report read the events
    ev = stored_events(spark, sf_dir)
    labels = reliable_checkpoint(cohort.phenotype_labels(ev.dx, ev.med, ev.lab))
    parts = []
    for arm, filtered in (("all", False), ("filtered", True)):
        own = _all_tuples(spark, sf_dir, filtered, ev).select("patient_id").distinct().join(labels, "patient_id")
        sizes = own.groupBy("label").agg(F.count("*").alias("c"))
        parts.append(sizes.agg((F.max("c") / F.sum("c")).alias("share")).withColumn("arm", F.lit(arm)))
    found = report(ev.dx, ev.med, ev.lab, labels).join(parts[0].unionByName(parts[1]), "arm")
    ok = (F.col("purity") >= F.col("share") - 1e-9) & (F.col("purity") <= 1.0)
    return found.select("arm", "algorithm", "n", ok.alias("purity_in_bounds"))


@query
def score_new_patients(spark, sf_dir):
    """M7: scaler and components fitted on the patients with an even id and saved; the
    loaded model projects every patient; checked per patient against the projection from
    the long form."""
    from pyspark.ml.functions import vector_to_array

    from ..session import scratch_path
    from .learn import ClusteringExperiment, Projection, long_projection

    t = _stored_tuples(spark, sf_dir)
    d = features.feature_dictionary(t)
    long = reliable_checkpoint(features.feature_matrix_long(t, d))
    width = d.count()
    vectors = features.patient_vectors(long, width)
    fitted = F.col("patient_id").cast("long") % 2 == 0
    exp = ClusteringExperiment().fit(vectors.where(fitted), width, ())
    path = scratch_path(spark, "projection")
    exp.projection.write().save(path)
    # the projection is NumPy over Arrow batches: a step of its own, stored before the join
    scored = reliable_checkpoint(Projection.load(path).transform(vectors).select(
        "patient_id", vector_to_array("pca").alias("a")))
    expected = long_projection(long, exp.projection).withColumnRenamed("pca", "b")
    worst = F.array_max(F.zip_with("a", "b", lambda x, y: F.abs(x - y)))
    return scored.join(expected, "patient_id").select(
        "patient_id", fitted.alias("fitted"), (worst < 1e-6).alias("as_in_long_form"))
