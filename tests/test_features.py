"""Feature tuples and vectors: the original unit cases plus the duplicate-index guard."""

import pytest

from phenoscope.operators import features as feat

T = "2010-01-01T00:00:00"


def tuples(df):
    return sorted((r.patient_id, r.feature, r.value) for r in df.collect())


def test_diagnosis_counts(events):
    cases = [
        ([("p1", T, "code1")], [("p1", "code1", 1.0)]),
        ([("p1", T, "code1"), ("p1", T, "code2")], [("p1", "code1", 1.0), ("p1", "code2", 1.0)]),
        ([("p1", T, "code1")] * 2, [("p1", "code1", 2.0)]),
        ([("p1", T, "code1")] * 2 + [("p1", T, "code2")],
         [("p1", "code1", 2.0), ("p1", "code2", 1.0)]),
    ]
    for rows, expected in cases:
        dx, _, _ = events(dx=rows)
        assert tuples(feat.diagnostic_features(dx)) == expected


def test_diagnosis_candidate_filter(events):
    dx, _, _ = events(dx=[("p1", T, "code1")] * 2 + [("p1", T, "code2")])
    assert tuples(feat.diagnostic_features(dx, {"code2"})) == [("p1", "code2", 1.0)]
    assert tuples(feat.diagnostic_features(dx, {"code1"})) == [("p1", "code1", 2.0)]


def test_medication_counts(events):
    cases = [
        ([("p1", T, "code1")], [("p1", "code1", 1.0)]),
        ([("p1", T, "code1"), ("p1", T, "code2")], [("p1", "code1", 1.0), ("p1", "code2", 1.0)]),
        ([("p1", T, "code1")] * 2, [("p1", "code1", 2.0)]),
        ([("p1", T, "code1")] + [("p1", T, "code2")] * 2,
         [("p1", "code1", 1.0), ("p1", "code2", 2.0)]),
    ]
    for rows, expected in cases:
        _, med, _ = events(med=rows)
        assert tuples(feat.medication_features(med)) == expected


def test_medication_candidate_filter(events):
    _, med, _ = events(med=[("p1", T, "code1")] + [("p1", T, "code2")] * 2)
    assert tuples(feat.medication_features(med, {"code2"})) == [("p1", "code2", 2.0)]
    assert tuples(feat.medication_features(med, {"code1"})) == [("p1", "code1", 1.0)]


def test_lab_means(events):
    cases = [
        ([("p1", T, "code1", 42)], [("p1", "code1", 42.0)]),
        ([("p1", T, "code1", 42), ("p1", T, "code2", 24)],
         [("p1", "code1", 42.0), ("p1", "code2", 24.0)]),
        ([("p1", T, "code1", 42), ("p1", T, "code1", 24)], [("p1", "code1", 33.0)]),
        ([("p1", T, "code1", 42), ("p1", T, "code1", 24), ("p1", T, "code2", 7475)],
         [("p1", "code1", 33.0), ("p1", "code2", 7475.0)]),
    ]
    for rows, expected in cases:
        _, _, lab = events(lab=rows)
        assert tuples(feat.lab_features(lab)) == expected


def test_lab_candidate_filter(events, spark):
    _, _, lab = events(lab=[("p1", T, "code1", 42), ("p1", T, "code1", 24),
                            ("p1", T, "code2", 7475)])
    assert tuples(feat.lab_features(lab, {"code2"})) == [("p1", "code2", 7475.0)]
    # a term frame goes through the size-checked semi-join instead of IN
    terms = spark.createDataFrame([("code1",)], "term string")
    assert tuples(feat.lab_features(lab, terms)) == [("p1", "code1", 33.0)]


def _vectors(spark, rows):
    t = spark.createDataFrame(rows, "patient_id string, feature string, value double")
    d = feat.feature_dictionary(t)
    size = d.count()
    long = feat.feature_matrix_long(t, d)
    sparse = {r.patient_id: r.features.toArray().tolist()
              for r in feat.patient_vectors(long, size).collect()}
    dense = {r.patient_id: r.features.toArray().tolist()
             for r in feat.dense_patient_vectors(long, size).collect()}
    assert sparse == dense
    return sparse


def test_vectors_alphabetical_index(spark):
    v = _vectors(spark, [("p1", "code2", 42.0), ("p1", "code1", 24.0)])
    assert v == {"p1": [24.0, 42.0]}


def test_vectors_two_patients(spark):
    v = _vectors(spark, [("p1", "code0", 42.0), ("p1", "code2", 24.0), ("p2", "code1", 12.0)])
    assert v == {"p1": [42.0, 0.0, 24.0], "p2": [0.0, 12.0, 0.0]}


def test_dictionary_dense_ids_across_partitions(spark):
    names = [f"f{i:05d}" for i in range(3000)]
    t = spark.createDataFrame([("p", n, 1.0) for n in reversed(names)],
                              "patient_id string, feature string, value double").repartition(7)
    got = sorted((r.idx, r.feature) for r in feat.feature_dictionary(t).collect())
    assert got == list(enumerate(names))


def test_duplicate_feature_index_fails(spark):
    # the same feature name from two event types gives a patient one index twice
    t = spark.createDataFrame([("p1", "glucose", 1.0), ("p1", "glucose", 5.0)],
                              "patient_id string, feature string, value double")
    d = feat.feature_dictionary(t)
    long = feat.feature_matrix_long(t, d)
    with pytest.raises(Exception, match="duplicate"):
        feat.patient_vectors(long, 1).collect()
    with pytest.raises(Exception):
        feat.dense_patient_vectors(long, 1).collect()
