"""Spark operators against plain-Python brute force on random small inputs."""

from collections import Counter, defaultdict
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest

from phenoscope.operators import cohort
from phenoscope.operators import features as feat
from phenoscope.operators.metrics import purity
from phenoscope.sources.criteria import ABNORMAL_LAB_RULES, get_profile

DX_POOL = ["250.01", "250.00", "250.02", "250.13", "790.29", "648.00", "v77.1", "250.10",
           "code2", "401.9", "d1"]
MED_POOL = ["lantus", "insulin nph", "metformin", "glipizide", "insulin glargine", "aspirin"]
LAB_POOL = ["glucose", "fasting glucose", "glucose, serum", "hba1c", "ldl"]
BASE = datetime(2015, 1, 1, tzinfo=timezone.utc)


def _random_events(seed, n_patients=300):
    rng = np.random.RandomState(seed)
    dx, med, lab = [], [], []
    for p in range(n_patients):
        pid = f"p{p}"
        for _ in range(rng.randint(0, 4)):
            dx.append((pid, BASE + timedelta(hours=int(rng.randint(0, 50))),
                       DX_POOL[rng.randint(len(DX_POOL))]))
        for _ in range(rng.randint(0, 4)):
            # coarse times so first-order ties happen
            med.append((pid, BASE + timedelta(hours=int(rng.randint(0, 6))),
                        MED_POOL[rng.randint(len(MED_POOL))]))
        for _ in range(rng.randint(0, 3)):
            lab.append((pid, BASE, LAB_POOL[rng.randint(len(LAB_POOL))],
                        float(rng.choice([5.5, 6.0, 90.0, 110.0, 150.0]))))
    return dx, med, lab


def _brute_labels(dx, med, lab, profile):
    """One patient at a time: gather the facts, then decide by the label's rule."""
    p = get_profile(profile)
    out = {}
    for patient in sorted({r[0] for r in [*dx, *med, *lab]}):
        codes = [c for q, _, c in dx if q == patient]
        orders = [(ts, m) for q, ts, m in med if q == patient]
        tests = [(name, v) for q, _, name, v in lab if q == patient]
        first = [min((ts for ts, m in orders if m in drugs), default=None) for drugs in (p.t1dm_med, p.t2dm_med)]

        diagnosed = any(c in p.t2dm_dx for c in codes) and not any(c in p.t1dm_dx for c in codes)
        if first[0] is None or first[1] is None:
            order_fits = True
        else:
            order_fits = first[0] >= first[1]
        is_case = diagnosed and order_fits

        related = any(c in p.dm_related_dx or c.startswith(tuple(p.dm_related_prefixes)) for c in codes)
        abnormal = any(name == n and (v >= limit if op == ">=" else v > limit)
                       for name, v in tests for n, op, limit in ABNORMAL_LAB_RULES)
        may_be_control = any("glucose" in name for name, _ in tests) and not related
        if p.exclude_abnormal_from_controls and abnormal:
            may_be_control = False
        out[patient] = 1 if is_case else 2 if may_be_control else 3
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("profile", ["reference", "published"])
def test_labels_match_the_rule(spark, seed, profile):
    dx, med, lab = _random_events(seed)
    dxf = spark.createDataFrame(dx, "patient_id string, ts timestamp, code string")
    medf = spark.createDataFrame(med, "patient_id string, ts timestamp, medicine string")
    labf = spark.createDataFrame(lab, "patient_id string, ts timestamp, test_name string, "
                                      "value double")
    got = {r.patient_id: r.label
           for r in cohort.phenotype_labels(dxf, medf, labf, profile).collect()}
    assert got == _brute_labels(dx, med, lab, profile)


@pytest.mark.parametrize("seed", [4, 5])
def test_feature_tuples_match_brute_force(spark, seed):
    dx, med, lab = _random_events(seed, 100)
    dxf = spark.createDataFrame(dx, "patient_id string, ts timestamp, code string")
    medf = spark.createDataFrame(med, "patient_id string, ts timestamp, medicine string")
    labf = spark.createDataFrame(lab, "patient_id string, ts timestamp, test_name string, "
                                      "value double")
    got = {(r.patient_id, r.feature): r.value
           for r in feat.feature_tuples(dxf, medf, labf).collect()}
    exp = {}
    for (pid, code), n in Counter((r[0], r[2]) for r in dx).items():
        exp[(pid, code)] = float(n)
    for (pid, m), n in Counter((r[0], r[2]) for r in med).items():
        exp[(pid, m)] = float(n)
    sums = defaultdict(list)
    for pid, _, name, v in lab:
        sums[(pid, name)].append(v)
    for k, vs in sums.items():
        exp[k] = sum(vs) / len(vs)
    assert got.keys() == exp.keys()
    for k in exp:
        assert got[k] == pytest.approx(exp[k])


@pytest.mark.parametrize("seed", [6, 7, 8])
def test_purity_matches_brute_force(spark, seed):
    rng = np.random.RandomState(seed)
    pairs = [(int(rng.randint(4)), int(rng.randint(3))) for _ in range(500)]
    got = purity(spark.createDataFrame(pairs, "cluster int, label int")).first().purity
    per = defaultdict(Counter)
    for c, k in pairs:
        per[c][k] += 1
    assert got == pytest.approx(sum(max(v.values()) for v in per.values()) / len(pairs))


def test_hot_patient_holds_a_third_of_all_events(spark):
    dx, med, lab = _random_events(9, 200)
    rng = np.random.RandomState(10)
    n = (len(dx) + len(med) + len(lab)) // 2  # the hot patient ends with ~1/3 of all rows
    for i in range(n):
        kind = i % 3
        if kind == 0:
            dx.append(("hot", BASE, DX_POOL[rng.randint(len(DX_POOL))]))
        elif kind == 1:
            med.append(("hot", BASE + timedelta(hours=int(rng.randint(0, 6))),
                        MED_POOL[rng.randint(len(MED_POOL))]))
        else:
            lab.append(("hot", BASE, LAB_POOL[rng.randint(len(LAB_POOL))], 100.0 + i % 7))
    dxf = spark.createDataFrame(dx, "patient_id string, ts timestamp, code string").repartition(8)
    medf = spark.createDataFrame(med, "patient_id string, ts timestamp, medicine string")
    labf = spark.createDataFrame(lab, "patient_id string, ts timestamp, test_name string, "
                                      "value double").repartition(8)
    got = {r.patient_id: r.label
           for r in cohort.phenotype_labels(dxf, medf, labf, "reference").collect()}
    assert got == _brute_labels(dx, med, lab, "reference")
    tuples = {(r.patient_id, r.feature): r.value
              for r in feat.feature_tuples(dxf, medf, labf).where("patient_id = 'hot'").collect()}
    assert tuples[("hot", DX_POOL[0])] == float(sum(1 for r in dx if r[0] == "hot"
                                                    and r[2] == DX_POOL[0]))
