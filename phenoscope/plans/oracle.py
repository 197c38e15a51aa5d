"""DuckDB oracle SQL for the registered queries.

The oracle rebuilds the event tables from ``orders`` and ``lineitem`` straight
from the stand-in rules (instants from the source timestamps, numbers from the
integer cents; no text round trip), and decides the cohort by rule: for each
patient, whether an event of a kind exists, so it checks the single-aggregate
flag table independently.
"""

from __future__ import annotations

from ..sources import standin
from ..sources.criteria import (
    ABNORMAL_LAB_RULES,
    PUBLISHED,
    REFERENCE,
    Profile,
    candidate_terms,
)


def _lit_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _case(h: str, table, other) -> str:
    prefix, modulus = other
    whens = " ".join(f"WHEN {h} < {b} THEN '{n}'" for b, n in table)
    return f"CASE {whens} ELSE '{prefix}' || CAST({h} % {modulus} AS VARCHAR) END"


def _events_cte() -> str:
    return f"""
li AS (
  SELECT l_orderkey, l_quantity, l_returnflag, l_shipdate,
         (l_orderkey * 31 + l_partkey * 17 + l_linenumber * 7) % 1000 AS h
  FROM lineitem
),
dx AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS patient_id, epoch_ms(o.o_orderdate) AS ts_ms,
         lower({_case('li.h', standin.DX_BY_HASH, standin.DX_OTHER)}) AS code
  FROM orders o JOIN li ON li.l_orderkey = o.o_orderkey
  WHERE li.l_returnflag = 'R'
),
med AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS patient_id,
         epoch_ms(CASE WHEN li.h < {standin.MED_TIED_BELOW}
                       THEN date_trunc('year', li.l_shipdate)::TIMESTAMP
                       ELSE li.l_shipdate::TIMESTAMP END) AS ts_ms,
         lower({_case('li.h', standin.MED_BY_HASH, standin.MED_OTHER)}) AS medicine
  FROM li JOIN orders o ON li.l_orderkey = o.o_orderkey
  WHERE li.l_returnflag = 'A'
),
lab AS (
  SELECT patient_id, ts_ms, test_name, CAST(c AS DOUBLE) / 100.0 AS value
  FROM (
    SELECT CAST(o.o_custkey AS VARCHAR) AS patient_id, epoch_ms(li.l_shipdate) AS ts_ms,
           lower({_case('li.h', standin.LAB_BY_HASH, standin.LAB_OTHER)}) AS test_name,
           CASE WHEN li.h % 7 = 0
                THEN (CAST(li.l_quantity AS BIGINT) * 400 + li.h % 100) * 1000
                ELSE CAST(li.l_quantity AS BIGINT) * 400 + li.h % 100 END AS c
    FROM li JOIN orders o ON li.l_orderkey = o.o_orderkey
    WHERE li.l_returnflag = 'N' AND li.h % 10 <> 0 AND li.h % 100 <> 55
  )
)"""


def _abnormal_expr(name: str = "test_name", value: str = "value") -> str:
    parts = [f"({name} = '{t}' AND {value} {op} {thr})" for t, op, thr in ABNORMAL_LAB_RULES]
    return "(" + " OR ".join(parts) + ")"


def _cohort_cte(p: Profile, suffix: str = "") -> str:
    s = suffix

    def has(table: str, condition: str) -> str:
        return f"EXISTS (SELECT 1 FROM {table} e WHERE e.patient_id = s.patient_id AND ({condition}))"

    def first(terms) -> str:
        return (f"(SELECT min(e.ts_ms) FROM med e WHERE e.patient_id = s.patient_id "
                f"AND e.medicine IN ({_lit_list(terms)}))")

    related = " OR ".join([f"e.code IN ({_lit_list(p.dm_related_dx)})"]
                          + [f"starts_with(e.code, '{x}')" for x in p.dm_related_prefixes])
    clean = "AND NOT abnormal" if p.exclude_abnormal_from_controls else ""
    return f"""
spine{s} AS (
  SELECT patient_id FROM dx UNION SELECT patient_id FROM med UNION SELECT patient_id FROM lab
),
facts{s} AS (
  SELECT s.patient_id,
         {has('dx', f"e.code IN ({_lit_list(p.t1dm_dx)})")} AS t1_dx,
         {has('dx', f"e.code IN ({_lit_list(p.t2dm_dx)})")} AS t2_dx,
         {has('dx', related)} AS related,
         {has('lab', "contains(e.test_name, 'glucose')")} AS glucose,
         {has('lab', _abnormal_expr('e.test_name', 'e.value'))} AS abnormal,
         {first(p.t1dm_med)} AS first_t1,
         {first(p.t2dm_med)} AS first_t2
  FROM spine{s} s
),
rules{s} AS (
  SELECT *, t2_dx AND NOT t1_dx AND first_t1 IS NULL AS path_1,
         t2_dx AND NOT t1_dx AND first_t1 IS NOT NULL AND first_t2 IS NULL AS path_2,
         t2_dx AND NOT t1_dx AND coalesce(first_t1 >= first_t2, false) AS path_3
  FROM facts{s}
),
labels{s} AS (
  SELECT *, CASE WHEN path_1 OR path_2 OR path_3 THEN 1
                 WHEN glucose AND NOT related {clean} THEN 2 ELSE 3 END AS label
  FROM rules{s}
)"""


def _features_cte() -> str:
    return f"""
dxf AS (SELECT patient_id, code AS feature, CAST(count(*) AS DOUBLE) AS value
        FROM dx GROUP BY patient_id, code),
medf AS (SELECT patient_id, medicine AS feature, CAST(count(*) AS DOUBLE) AS value
         FROM med GROUP BY patient_id, medicine),
labf AS (SELECT patient_id, test_name AS feature, avg(value) AS value
         FROM lab GROUP BY patient_id, test_name),
dxf_c AS (SELECT * FROM dxf WHERE feature IN ({_lit_list(candidate_terms('dx'))})),
medf_c AS (SELECT * FROM medf WHERE feature IN ({_lit_list(candidate_terms('med'))})),
labf_c AS (SELECT * FROM labf WHERE feature IN ({_lit_list(candidate_terms('lab'))})),
tuples AS (SELECT * FROM dxf UNION ALL SELECT * FROM labf UNION ALL SELECT * FROM medf),
tuples_c AS (SELECT * FROM dxf_c UNION ALL SELECT * FROM labf_c UNION ALL SELECT * FROM medf_c),
dict AS (SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS idx
         FROM (SELECT DISTINCT feature FROM tuples)),
mlong AS (SELECT t.patient_id, d.idx, t.value FROM tuples t JOIN dict d USING (feature))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


BASE = _with(_events_cte(), _cohort_cte(REFERENCE), _cohort_cte(PUBLISHED, "_pub"),
             _features_cte())


def _q(body: str) -> str:
    return BASE + "\n" + body


def _code_set_members(p: Profile) -> str:
    prefix = " OR ".join(f"substr(code, 1, {len(x)}) = '{x}'" for x in p.dm_related_prefixes)
    return _q(f"""
SELECT DISTINCT 't1dm_dx' AS set_name, patient_id FROM dx WHERE code IN ({_lit_list(p.t1dm_dx)})
UNION SELECT DISTINCT 't2dm_dx', patient_id FROM dx WHERE code IN ({_lit_list(p.t2dm_dx)})
UNION SELECT DISTINCT 't1dm_med', patient_id FROM med
      WHERE medicine IN ({_lit_list(p.t1dm_med)})
UNION SELECT DISTINCT 't2dm_med', patient_id FROM med
      WHERE medicine IN ({_lit_list(p.t2dm_med)})
UNION SELECT DISTINCT 'dm_related_dx', patient_id FROM dx
      WHERE code IN ({_lit_list(p.dm_related_dx)}) OR {prefix}
""")


_EMB = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, label FROM embeddings),
c AS (SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS cluster, x AS cx
      FROM e ORDER BY vec_id LIMIT 3),
d AS (
  SELECT e.vec_id, c.cluster,
         list_reduce(list_transform(range(1, len(e.x) + 1),
                                    lambda i: (e.x[i] - c.cx[i]) * (e.x[i] - c.cx[i])),
                     lambda a, b: a + b, 0.0) AS dist
  FROM e, c
),
a AS (
  SELECT vec_id, cluster FROM (
    SELECT vec_id, cluster,
           row_number() OVER (PARTITION BY vec_id ORDER BY dist, cluster) AS rn FROM d)
  WHERE rn = 1
),
u AS (SELECT vec_id, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM e),
agg AS (
  SELECT a.cluster, u.i, sum(u.v) AS s, count(*) AS n
  FROM a JOIN u ON a.vec_id = u.vec_id GROUP BY a.cluster, u.i
)
"""

def _lloyd(steps: int) -> str:
    """The steps of k-means unrolled: assignment, then means, from the fixed centres."""
    parts = [_EMB.split("d AS (")[0].rstrip().rstrip(","), """
u AS (SELECT vec_id, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM e)""",
             "c0 AS (SELECT * FROM c)"]
    for k in range(steps):
        parts.append(f"""
a{k} AS (
  SELECT vec_id, cluster FROM (
    SELECT e.vec_id, c.cluster, row_number() OVER (PARTITION BY e.vec_id ORDER BY
             list_reduce(list_transform(range(1, len(e.x) + 1),
                                        lambda i: (e.x[i] - c.cx[i]) * (e.x[i] - c.cx[i])),
                         lambda a, b: a + b, 0.0), c.cluster) AS rn
    FROM e, c{k} c) WHERE rn = 1)""")
        parts.append(f"""
c{k + 1} AS (SELECT cluster, list(v ORDER BY i) AS cx FROM (
  SELECT a.cluster, u.i, avg(u.v) AS v FROM a{k} a JOIN u USING (vec_id) GROUP BY a.cluster, u.i)
  GROUP BY cluster)""")
    return ",".join(parts) + f"""
SELECT cluster, CAST(generate_subscripts(cx, 1) - 1 AS INTEGER) AS dim, round(unnest(cx), 6) AS value
FROM c{steps}"""


def _seeds(rounds: int, k: int = 3, seed: int = 6250) -> str:
    def share(number):
        return f"('0x' || md5(concat('{seed}:{number}:', vec_id))[1:13])::BIGINT / 4503599627370496.0"

    apart = "list_sum(list_transform(range(1, len(e.x) + 1), lambda i: (e.x[i] - c.x[i]) * (e.x[i] - c.x[i])))"
    parts = [f"""WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
c0 AS (SELECT 0 AS r, vec_id, x FROM e ORDER BY {share(0)}, vec_id LIMIT 1)"""]
    for n in range(1, rounds + 1):
        parts.append(f"""
d{n} AS (SELECT e.vec_id, min({apart}) AS d FROM e, c{n - 1} c GROUP BY e.vec_id),
c{n} AS (SELECT * FROM c{n - 1} UNION ALL
  SELECT {n}, e.vec_id, x FROM e JOIN d{n} USING (vec_id)
  WHERE {share(n)} * (SELECT sum(d) FROM d{n}) < {2 * k} * d)""")
    return ",".join(parts) + f""",
o AS (SELECT *, row_number() OVER (ORDER BY r, vec_id) AS j FROM c{rounds}),
a AS (SELECT e.vec_id, arg_min(j, ({apart}, j)) AS j FROM e, o c GROUP BY e.vec_id)
SELECT o.vec_id, count(a.vec_id) AS weight FROM o LEFT JOIN a USING (j) GROUP BY o.vec_id, o.j"""


def _online_batches(batches: int) -> str:
    """The online update unrolled over batches by ``vec_id % batches``, in that order."""
    parts = [_EMB.split("d AS (")[0].rstrip().rstrip(","), """
u AS (SELECT vec_id, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM e)""",
             "c0 AS (SELECT cluster, cx, 0.5::DOUBLE AS w FROM c)"]
    for k in range(batches):
        parts.append(f"""
a{k} AS (
  SELECT vec_id, cluster FROM (
    SELECT e.vec_id, c.cluster, row_number() OVER (PARTITION BY e.vec_id ORDER BY
             list_reduce(list_transform(range(1, len(e.x) + 1),
                                        lambda i: (e.x[i] - c.cx[i]) * (e.x[i] - c.cx[i])),
                         lambda a, b: a + b, 0.0), c.cluster) AS rn
    FROM e, c{k} c WHERE e.vec_id % {batches} = {k}) WHERE rn = 1)""")
        parts.append(f"""
s{k} AS (SELECT cluster, max(n) AS n, list(s ORDER BY i) AS sx FROM (
  SELECT a.cluster, u.i, sum(u.v) AS s, count(*) AS n FROM a{k} a JOIN u USING (vec_id)
  GROUP BY a.cluster, u.i) GROUP BY cluster)""")
        parts.append(f"""
c{k + 1} AS (
  SELECT c.cluster, CASE WHEN n IS NULL THEN cx ELSE list_transform(range(1, len(cx) + 1),
           lambda i: cx[i] * (1.0 - n / (w + n)) + sx[i] * ((n / (w + n)) / n)) END AS cx,
         w + coalesce(n, 0) AS w
  FROM c{k} c LEFT JOIN s{k} s USING (cluster))""")
    return ",".join(parts) + f"""
SELECT cluster, CAST(generate_subscripts(cx, 1) - 1 AS INTEGER) AS dim, round(unnest(cx), 6) AS value,
       w AS weight
FROM c{batches}"""


ORACLE: dict[str, str] = {
    "lab_extract": _q("SELECT patient_id, ts_ms, test_name, value FROM lab"),
    "med_extract": _q("SELECT patient_id, ts_ms, medicine FROM med"),
    "dx_extract": _q("SELECT patient_id, ts_ms, code FROM dx"),
    "patient_spine": _q("SELECT patient_id FROM spine"),
    "code_set_members": _code_set_members(REFERENCE),
    "code_set_members_published": _code_set_members(PUBLISHED),
    "code_set_members_file": _code_set_members(PUBLISHED),
    "dx_prefix_members": _q("SELECT DISTINCT patient_id FROM dx WHERE substr(code, 1, 3) = '250'"),
    "abnormal_labs": _q("SELECT patient_id FROM facts WHERE abnormal"),
    "first_drug_dates": _q(
        "SELECT patient_id, first_t1 AS first_t1_ms, first_t2 AS first_t2_ms "
        "FROM facts WHERE first_t1 IS NOT NULL AND first_t2 IS NOT NULL"
    ),
    "patients_without_t1dx": _q(
        "SELECT patient_id FROM facts WHERE NOT t1_dx"
    ),
    "patients_with_both_drugs": _q(
        "SELECT patient_id FROM facts WHERE first_t1 IS NOT NULL AND first_t2 IS NOT NULL"
    ),
    "case_path_1": _q("SELECT patient_id FROM rules WHERE path_1"),
    "case_path_2": _q("SELECT patient_id FROM rules WHERE path_2"),
    "case_path_3": _q("SELECT patient_id FROM rules WHERE path_3"),
    "cases": _q("SELECT patient_id FROM labels WHERE label = 1"),
    "glucose_tested": _q("SELECT patient_id FROM facts WHERE glucose"),
    "controls": _q("SELECT patient_id FROM labels WHERE label = 2"),
    "controls_published": _q("SELECT patient_id FROM labels_pub WHERE label = 2"),
    "others": _q("SELECT patient_id FROM labels WHERE label = 3"),
    "phenotype_labels": _q("SELECT patient_id, label FROM labels"),
    "phenotype_labels_published": _q("SELECT patient_id, label FROM labels_pub"),
    "phenotype_label_counts": _q("SELECT label, count(*) AS n FROM labels GROUP BY label"),
    "dx_counts": _q("SELECT patient_id, feature, round(value, 6) AS value FROM dxf"),
    "med_counts": _q("SELECT patient_id, feature, round(value, 6) AS value FROM medf"),
    "lab_means": _q("SELECT patient_id, feature, round(value, 6) AS value FROM labf"),
    "dx_counts_filtered": _q("SELECT patient_id, feature, round(value, 6) AS value FROM dxf_c"),
    "med_counts_filtered": _q("SELECT patient_id, feature, round(value, 6) AS value FROM medf_c"),
    "med_counts_filtered_terms": _q(
        "SELECT patient_id, feature, round(value, 6) AS value FROM medf_c"
    ),
    "lab_means_filtered": _q("SELECT patient_id, feature, round(value, 6) AS value FROM labf_c"),
    "feature_tuples": _q("SELECT patient_id, feature, round(value, 6) AS value FROM tuples"),
    "feature_tuples_filtered": _q(
        "SELECT patient_id, feature, round(value, 6) AS value FROM tuples_c"
    ),
    "feature_dictionary": _q("SELECT feature, idx FROM dict"),
    "feature_matrix_long": _q("SELECT patient_id, idx, round(value, 6) AS value FROM mlong"),
    "feature_vectors": _q(
        "SELECT patient_id, (SELECT count(*) FROM dict) AS size, count(*) AS nnz, "
        "round(sum(value), 6) AS total FROM mlong WHERE value <> 0 GROUP BY patient_id"
    ),
    "contingency": _q(
        "SELECT o_orderstatus AS cluster, o_orderpriority AS label, count(*) AS n "
        "FROM orders GROUP BY 1, 2"
    ),
    "purity_by_assignment": _q("""
SELECT CAST(sum(total) AS BIGINT) AS n, round(sum(best) / sum(total), 6) AS purity FROM (
  SELECT cluster, max(n) AS best, sum(n) AS total FROM (
    SELECT o_orderstatus AS cluster, o_orderpriority AS label, count(*) AS n
    FROM orders GROUP BY 1, 2) GROUP BY cluster)"""),
    "purity_vs_phenotype": _q("""
SELECT CAST(sum(total) AS BIGINT) AS n, round(sum(best) / sum(total), 6) AS purity FROM (
  SELECT cluster, max(n) AS best, sum(n) AS total FROM (
    SELECT c.c_mktsegment AS cluster, l.label, count(*) AS n
    FROM customer c JOIN labels l ON CAST(c.c_custkey AS VARCHAR) = l.patient_id
    GROUP BY 1, 2) GROUP BY cluster)"""),
    "csv_lab_roundtrip": _q("SELECT patient_id, ts_ms, test_name, value FROM lab"),
    "csv_med_roundtrip": _q("SELECT patient_id, ts_ms, medicine FROM med"),
    "csv_dx_roundtrip": _q("SELECT patient_id, ts_ms, code FROM dx"),
    "csv_rejected_rows": """
SELECT CASE l_returnflag WHEN 'N' THEN 'lab_results_INPUT' ELSE 'medication_orders_INPUT' END AS extract, count(*) AS n
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_returnflag IN ('N', 'A') AND o_custkey % 10 = 0 GROUP BY 1
UNION ALL SELECT 'encounter_INPUT', count(*) FROM orders WHERE o_orderkey % 10 = 0
UNION ALL SELECT 'encounter_dx_INPUT', count(*) FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey % 10 = 0""",
    "term_set": _q("SELECT DISTINCT medicine AS term FROM med"),
    "label_sink_roundtrip": _q("SELECT patient_id, label FROM labels"),
    "feature_sink_roundtrip": _q(
        "SELECT patient_id, feature, round(value, 6) AS value FROM tuples"
    ),
    "feature_moments": _q(""", np AS (SELECT count(DISTINCT patient_id) AS n FROM mlong),
mm AS (SELECT idx, sum(value) / (SELECT n FROM np) AS mean, count(*) AS nnz
       FROM mlong GROUP BY idx),
ss AS (SELECT m.idx, m.mean, m.nnz, sum((l.value - m.mean) * (l.value - m.mean)) AS ss
       FROM mlong l JOIN mm m ON l.idx = m.idx GROUP BY m.idx, m.mean, m.nnz)
SELECT idx, round(mean, 6) AS mean,
       round(sqrt((ss + ((SELECT n FROM np) - nnz) * mean * mean) / ((SELECT n FROM np) - 1.0)), 6)
           AS std
FROM ss"""),
    "nearest_centre": _EMB + "SELECT vec_id, cluster FROM a",
    "kmeans_one_step": _EMB + (
        "SELECT cluster, CAST(i - 1 AS INTEGER) AS dim, round(s / n, 6) AS value FROM agg"
    ),
    "online_kmeans_update": _EMB + """
SELECT agg.cluster, CAST(agg.i - 1 AS INTEGER) AS dim,
       round(c.cx[agg.i] * (1.0 - agg.n / (0.5 + agg.n))
             + agg.s * ((agg.n / (0.5 + agg.n)) / agg.n), 6) AS value,
       CAST(0.5 + agg.n AS DOUBLE) AS weight
FROM agg JOIN c ON agg.cluster = c.cluster""",
    "online_kmeans_stream": _EMB + """
SELECT agg.cluster, CAST(agg.i - 1 AS INTEGER) AS dim,
       round(c.cx[agg.i] * (1.0 - agg.n / (0.5 + agg.n))
             + agg.s * ((agg.n / (0.5 + agg.n)) / agg.n), 6) AS value,
       CAST(0.5 + agg.n AS DOUBLE) AS weight
FROM agg JOIN c ON agg.cluster = c.cluster""",
    "embedding_purity": _EMB + """
SELECT CAST(sum(total) AS BIGINT) AS n, round(sum(best) / sum(total), 6) AS purity FROM (
  SELECT cluster, max(n) AS best, sum(n) AS total FROM (
    SELECT a.cluster, e.label, count(*) AS n FROM a JOIN e ON a.vec_id = e.vec_id
    GROUP BY 1, 2) GROUP BY cluster)""",
    "standardised_values": _q(""", np AS (SELECT count(DISTINCT patient_id) AS n FROM mlong),
st AS (
  SELECT d.idx, m.mean, m.sd FROM dict d JOIN (
    SELECT idx, sum(value) / (SELECT n FROM np) AS mean,
           sqrt((sum(value * value) - sum(value) * sum(value) / (SELECT n FROM np))
                / ((SELECT n FROM np) - 1)) AS sd
    FROM mlong GROUP BY idx) m ON m.idx = d.idx
),
pts AS (SELECT DISTINCT patient_id FROM mlong)
SELECT p.patient_id, CAST(st.idx AS INTEGER) AS idx,
       round(CASE WHEN st.sd = 0 THEN 0.0
                  ELSE (coalesce(l.value, 0.0) - st.mean) / st.sd END, 6) AS value
FROM pts p CROSS JOIN st
LEFT JOIN mlong l ON l.patient_id = p.patient_id AND l.idx = st.idx"""),
    "standardised_entries": _q(""", np AS (SELECT count(DISTINCT patient_id) AS n FROM mlong),
st AS (
  SELECT idx, sum(value) / (SELECT n FROM np) AS mean,
         sqrt((sum(value * value) - sum(value) * sum(value) / (SELECT n FROM np))
              / ((SELECT n FROM np) - 1)) AS sd
  FROM mlong GROUP BY idx)
SELECT patient_id, idx, round(CASE WHEN sd = 0 THEN 0.0 ELSE value / sd END, 6) AS value
FROM mlong JOIN st USING (idx)
UNION ALL SELECT NULL, idx, round(CASE WHEN sd = 0 THEN 0.0 ELSE -mean / sd END, 6) FROM st"""),
    "gmm_one_step": _EMB + """,
l AS (SELECT vec_id, cluster, -0.5 * dist - ln(3.0) AS l FROM d),
t AS (SELECT vec_id, max(l) AS m FROM l GROUP BY vec_id),
w AS (SELECT vec_id, m, sum(exp(l - m)) AS s FROM l JOIN t USING (vec_id) GROUP BY vec_id, m),
r AS (SELECT vec_id, cluster, exp(l - m) / s AS r FROM l JOIN w USING (vec_id)),
n AS (SELECT cluster, sum(r) AS n FROM r GROUP BY cluster),
mu AS (SELECT cluster, i, sum(r * v) / any_value(n) AS mu FROM r JOIN u USING (vec_id) JOIN n USING (cluster)
       GROUP BY cluster, i),
cv AS (SELECT cluster, x.i, y.i AS j, sum(r * x.v * y.v) / any_value(n) AS s
       FROM r JOIN u x USING (vec_id) JOIN u y USING (vec_id) JOIN n USING (cluster)
       WHERE x.i <= y.i GROUP BY cluster, x.i, y.i),
parts AS (
  SELECT -1 AS component, -1 AS i, -1 AS j, avg(m + ln(s)) - len(any_value(x)) / 2.0 * ln(2 * pi()) AS value
  FROM w JOIN e USING (vec_id)
  UNION ALL SELECT cluster, -1, -1, n / (SELECT count(*) FROM e) FROM n
  UNION ALL SELECT cluster, i - 1, -1, mu FROM mu
  UNION ALL SELECT cv.cluster, cv.i - 1, cv.j - 1, s - a.mu * b.mu
  FROM cv JOIN mu a ON a.cluster = cv.cluster AND a.i = cv.i JOIN mu b ON b.cluster = cv.cluster AND b.i = cv.j)
SELECT component::INTEGER AS component, i::INTEGER AS i, j::INTEGER AS j, round(value, 6) + 0.0 AS value FROM parts""",
    "covariance_entries": _q(""", np AS (SELECT count(DISTINCT patient_id) AS n FROM mlong),
mm AS (SELECT idx, sum(value) / (SELECT n FROM np) AS mean,
              (sum(value * value) - sum(value) * sum(value) / (SELECT n FROM np))
              / ((SELECT n FROM np) - 1) AS var
       FROM mlong GROUP BY idx),
sp AS (SELECT a.idx AS i, b.idx AS j, sum(a.value * b.value) AS s
       FROM mlong a JOIN mlong b ON a.patient_id = b.patient_id GROUP BY a.idx, b.idx),
grid AS (SELECT x.idx AS i, y.idx AS j FROM dict x CROSS JOIN dict y)
SELECT CAST(g.i AS INTEGER) AS i, CAST(g.j AS INTEGER) AS j,
       round(CASE WHEN a.var = 0 OR b.var = 0 THEN 0.0
                  ELSE (coalesce(sp.s, 0.0) - (SELECT n FROM np) * a.mean * b.mean)
                       / ((SELECT n FROM np) - 1) / sqrt(a.var * b.var) END, 6) AS value
FROM grid g JOIN mm a ON a.idx = g.i JOIN mm b ON b.idx = g.j
LEFT JOIN sp ON sp.i = g.i AND sp.j = g.j"""),
    "kmeans_seeds": _seeds(2),
    "kmeans_lloyd_steps": _lloyd(3),
    "online_kmeans_two_batches": _online_batches(2),
    "pca_certificate": _q(
        "SELECT (SELECT count(DISTINCT patient_id) FROM tuples) AS n, "
        "least(10, (SELECT count(*) FROM dict))::INTEGER AS k, true AS orthonormal, "
        "true AS uncorrelated, true AS centred, true AS falling, true AS settled, true AS explains_as_much"
    ),
    "kmeans_certificate": _q(
        "SELECT count(DISTINCT patient_id) AS n, true AS nearest, true AS step_gains, true AS settled FROM tuples"
    ),
    "online_kmeans_certificate": _q(
        "SELECT count(DISTINCT patient_id) AS n, true AS nearest, true AS step_gains FROM tuples"
    ),
    "gmm_certificate": _q(
        "SELECT count(DISTINCT patient_id) AS n, true AS sums_to_one, true AS likeliest, "
        "true AS weights_sum_to_one, true AS step_gains, true AS beats_one FROM tuples"
    ),
    "experiment_certificate": _q("""
SELECT arm, algorithm, n, true AS purity_in_bounds
FROM (SELECT 'all' AS arm, count(DISTINCT patient_id) AS n FROM tuples
      UNION ALL SELECT 'filtered', count(DISTINCT patient_id) FROM tuples_c),
     (VALUES ('kmeans'), ('gmm'), ('streaming_kmeans')) v(algorithm)"""),
    "score_new_patients": _q(
        "SELECT DISTINCT patient_id, CAST(patient_id AS BIGINT) % 2 = 0 AS fitted, "
        "true AS as_in_long_form FROM tuples"
    ),
}

ORACLE["covariance_in_tasks"] = ORACLE["covariance_entries"]
