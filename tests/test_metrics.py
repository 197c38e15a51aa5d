"""Purity: the original's two cases and an empty input."""

import pytest

from phenoscope.operators.metrics import contingency, purity


def _pairs(spark, counts):
    rows = [(c, k) for (c, k), n in counts.items() for _ in range(n)]
    return spark.createDataFrame(rows, "cluster int, label int")


def test_purity_case_one(spark):
    df = _pairs(spark, {(1, 2): 1, (1, 3): 5, (2, 1): 1, (2, 2): 4, (2, 3): 1, (3, 1): 3,
                        (3, 3): 2})
    r = purity(df).first()
    assert r.n == 17
    assert r.purity == pytest.approx(12 / 17, abs=1e-3)


def test_purity_case_two(spark):
    df = _pairs(spark, {(1, 2): 53, (1, 3): 10, (2, 2): 1, (2, 3): 60, (3, 2): 16})
    assert purity(df).first().purity == pytest.approx(129 / 140, abs=1e-3)


def test_purity_empty_is_null(spark):
    r = purity(spark.createDataFrame([], "cluster int, label int")).first()
    assert r.n == 0 and r.purity is None


def test_contingency_counts(spark):
    df = _pairs(spark, {(1, 2): 3, (2, 2): 1})
    assert sorted(tuple(r) for r in contingency(df).collect()) == [(1, 2, 3), (2, 2, 1)]
