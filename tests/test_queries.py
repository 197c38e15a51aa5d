"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01)."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from phenoscope.plans.oracle import ORACLE
from phenoscope.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
# fitted models: their certificates have SQL
ROWS_ONLY = {"pca_projection", "kmeans_assign", "gmm_assign", "online_kmeans_assign",
             "experiment_report"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return c


def _norm(rows):
    def n(v):
        return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v
    return sorted((tuple(n(x) for x in r) for r in rows), key=repr)


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


# Spark type → DuckDB type, for the schema half of the driver's comparison
SQL_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
             "float": "FLOAT", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ROWS_ONLY))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    cols = sorted(df.columns)
    rel = con.sql(ORACLE[name])
    assert {f.name: SQL_TYPES.get(f.dataType.simpleString()) for f in df.schema.fields} == \
        dict(zip(rel.columns, (str(t) for t in rel.types)))
    odf = rel.fetchdf()
    assert sorted(odf.columns) == cols
    got = _norm(df.select(*cols).collect())
    exp = _norm(odf[cols].itertuples(index=False, name=None))
    assert got == exp


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["patient_id", "label"]
    assert df.count() > 0


def test_experiment_report_shape(spark):
    rows = queries()["experiment_report"](spark, SF_DIR).collect()
    assert {(r.arm, r.algorithm) for r in rows} == {
        (a, g) for a in ("all", "filtered") for g in ("kmeans", "gmm", "streaming_kmeans")}
    for r in rows:
        assert r.n > 0 and 0.0 < r.purity <= 1.0
