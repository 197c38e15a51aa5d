"""Case / control / other labelling on hand-built patients, both profiles."""

from phenoscope.operators import cohort

DAY = "2012-03-04"


def _labels(dx, med, lab, profile):
    return {r.patient_id: r.label for r in cohort.phenotype_labels(dx, med, lab, profile).collect()}


def _fixture(events):
    dx = [
        ("case1", f"{DAY}T10:00:00", "250.00"),
        ("case2", f"{DAY}T10:00:00", "250.02"),
        ("case3", f"{DAY}T10:00:00", "250.00"),
        ("tie", f"{DAY}T10:00:00", "250.00"),
        ("t1_earlier", f"{DAY}T10:00:00", "250.00"),
        ("both_dx", f"{DAY}T10:00:00", "250.01"),
        ("both_dx", f"{DAY}T10:00:00", "250.00"),
        ("glargine", f"{DAY}T10:00:00", "250.00"),
        ("code2", f"{DAY}T10:00:00", "code2"),
        ("gestational", f"{DAY}T10:00:00", "648.00"),
        ("screening", f"{DAY}T10:00:00", "v77.1"),
    ]
    med = [
        ("case2", f"{DAY}T10:00:00", "lantus"),
        ("case3", f"{DAY}T10:00:00", "lantus"),
        ("case3", f"{DAY}T09:00:00", "metformin"),
        ("tie", f"{DAY}T09:00:00", "lantus"),
        ("tie", f"{DAY}T09:00:00", "metformin"),
        ("t1_earlier", f"{DAY}T08:59:59", "lantus"),
        ("t1_earlier", f"{DAY}T09:00:00", "metformin"),
        ("glargine", f"{DAY}T09:00:00", "insulin glargine"),
        ("drug_only", f"{DAY}T09:00:00", "aspirin"),
    ]
    lab = [
        ("control", f"{DAY}T09:00:00", "glucose", 90),
        ("abnormal", f"{DAY}T09:00:00", "glucose", 200),
        ("code2", f"{DAY}T09:00:00", "glucose", 90),
        ("gestational", f"{DAY}T09:00:00", "fasting glucose", 80),
        ("screening", f"{DAY}T09:00:00", "glucose, serum", 80),
    ]
    return events(dx, med, lab)


def test_reference_profile(events):
    dx, med, lab = _fixture(events)
    assert _labels(dx, med, lab, "reference") == {
        "case1": 1, "case2": 1, "case3": 1, "tie": 1, "glargine": 1,
        "t1_earlier": 3,           # first T1DM order one second before the first T2DM order
        "both_dx": 3,              # T1DM and T2DM diagnoses
        "control": 2,
        "abnormal": 2,             # abnormal labs do not exclude controls here
        "code2": 1,                # case and control: one row, case wins
        "gestational": 2,          # 648.00 is not in the used DM-related set
        "screening": 2,            # upper-case V77.1 never matches lower-cased codes
        "drug_only": 3,
    }


def test_published_profile(events):
    dx, med, lab = _fixture(events)
    got = _labels(dx, med, lab, "published")
    assert got["abnormal"] == 3
    assert got["control"] == 2
    assert got["gestational"] == 3
    assert got["screening"] == 3
    assert got["code2"] == 2       # no sentinel codes in the published sets


def test_case_paths_and_flags(events):
    dx, med, lab = _fixture(events)
    flags = cohort.case_path_columns(cohort.patient_flags(dx, med, lab, "reference"))
    rows = {r.patient_id: r for r in flags.collect()}
    assert rows["case1"].case_path_1 and not rows["case1"].case_path_2
    assert rows["case2"].case_path_2
    assert rows["case3"].case_path_3 and rows["tie"].case_path_3
    assert not rows["t1_earlier"].case_path_3
    # ' insulin glargine' (leading blank) is the T1DM term in the reference profile
    assert not rows["glargine"].t1_med
    pub = {r.patient_id: r for r in cohort.patient_flags(dx, med, lab, "published").collect()}
    assert pub["glargine"].t1_med


def test_set_operations(events):
    dx, med, lab = _fixture(events)
    spine = {r.patient_id for r in cohort.patient_spine(dx, med, lab).collect()}
    assert len(spine) == 13
    no_t1 = {r.patient_id for r in cohort.patients_without_t1_dx(dx, med, lab).collect()}
    assert no_t1 == spine - {"both_dx"}
    both = {r.patient_id for r in cohort.patients_with_both_drugs(med).collect()}
    assert both == {"case3", "tie", "t1_earlier"}
    first = {r.patient_id: (r.first_t1_med, r.first_t2_med)
             for r in cohort.first_drug_orders(med).collect()}
    assert set(first) == both
    assert {r.patient_id for r in cohort.glucose_tested(lab).collect()} == {
        "control", "abnormal", "code2", "gestational", "screening"}
    assert {r.patient_id for r in cohort.dx_prefix_patients(dx).collect()} == {
        "case1", "case2", "case3", "tie", "t1_earlier", "both_dx", "glargine"}


def test_abnormal_rule_table(events, spark):
    from phenoscope.sources.criteria import lab_rules_frame

    _, _, lab = events(lab=[
        ("a", "2012-01-01T00:00:00", "hba1c", 6.0),
        ("b", "2012-01-01T00:00:00", "glucose", 110),
        ("c", "2012-01-01T00:00:00", "glucose", 110.5),
        ("d", "2012-01-01T00:00:00", "fasting glucose", 110),
    ])
    got = {r.patient_id for r in cohort.abnormal_lab_patients(lab, lab_rules_frame(spark)).collect()}
    assert got == {"a", "c", "d"}


def test_code_set_members(events, spark):
    from phenoscope.sources.criteria import criteria_frame

    dx, med, _ = _fixture(events)
    got = {(r.set_name, r.patient_id)
           for r in cohort.code_set_members(dx, med, criteria_frame(spark)).collect()}
    assert ("t2dm_dx", "code2") in got
    assert ("dm_related_dx", "case1") in got         # through the 250 prefix
    assert ("dm_related_dx", "gestational") not in got
    assert ("t1dm_med", "case2") in got
