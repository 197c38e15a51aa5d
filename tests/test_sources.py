"""Sources, cleaning expressions and sinks."""

import os
import shutil
import tempfile

import pytest

from phenoscope.operators.extract import extract_labs, extract_medications
from phenoscope.sources.csv import infer_table_name, read_csv_table
from phenoscope.sources.sinks import read_features, read_labels, write_features, write_labels
from phenoscope.sources.terms import read_term_set

LAB_COLS = "Member_ID string, Date_Collected string, Result_Name string, Numeric_Result string"


def _raw_labs(spark, values):
    rows = [(f"p{i}", "2010-01-01T00:00:00Z", "Glucose", v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, LAB_COLS)


def test_numbers_with_separators_and_missing(spark):
    raw = _raw_labs(spark, ["1,234.5", "", None, "7"])
    got = sorted(r.value for r in extract_labs(raw).collect())
    assert got == [7.0, 1234.5]


def test_nan_kept_or_dropped(spark):
    raw = _raw_labs(spark, ["NaN", "3"])
    assert len(extract_labs(raw).collect()) == 2
    assert [r.value for r in extract_labs(raw, drop_nan=True).collect()] == [3.0]


def test_bad_number_fails_or_drops(spark):
    raw = _raw_labs(spark, ["abc", "3"])
    with pytest.raises(Exception):
        extract_labs(raw).collect()
    assert [r.value for r in extract_labs(raw, on_error="drop").collect()] == [3.0]


def test_null_name_fails_or_drops(spark):
    raw = spark.createDataFrame([("p1", "2010-01-01T00:00:00Z", None), ("p2",
                                 "2010-01-01T00:00:00Z", "Lantus")],
                                "Member_ID string, Order_Date string, Drug_Name string")
    with pytest.raises(Exception):
        extract_medications(raw).collect()
    assert [r.medicine for r in extract_medications(raw, on_error="drop").collect()] == ["lantus"]


def test_instants_with_zones(spark):
    raw = spark.createDataFrame(
        [("a", "2010-01-01T10:00:00Z", "x"), ("b", "2010-01-01T12:00:00+02", "x"),
         ("c", "2010-01-01T12:00:00+0200", "x"), ("d", "2010-01-01T10:00:01Z", "x")],
        "Member_ID string, Order_Date string, Drug_Name string")
    from pyspark.sql import functions as F

    got = {r.patient_id: r.ms for r in
           extract_medications(raw).select("patient_id", F.unix_millis("ts").alias("ms")).collect()}
    assert got["a"] == got["b"] == got["c"] == 1262340000000
    assert got["d"] - got["a"] == 1000  # an instant, not a date


def test_csv_malformed_rows_same_for_every_read(spark):
    d = tempfile.mkdtemp()
    path = os.path.join(d, "lab_results_INPUT.csv")
    with open(path, "w") as f:
        f.write("a,b,c\n1,2,3\n4,5\n6,7,8,9\n10,11,12\n\"x,y\",13,14\n")
    df = read_csv_table(spark, path, columns=["a", "b", "c"])
    full = df.collect()
    assert [r.a for r in full] == ["1", "10", "x,y"]
    assert df.count() == 3
    assert len(df.select("a").collect()) == 3
    # the view is named after the path
    assert spark.table("lab_results_INPUT").count() == 3


def test_csv_columns_go_by_name(spark):
    d = tempfile.mkdtemp()
    path = os.path.join(d, "medication_orders_INPUT.csv")
    os.mkdir(path)
    with open(f"{path}/1.csv", "w") as f:
        f.write("Drug_Name,Note,Member_ID,Order_Date\n Lantus ,x,p1,2010-01-01T00:00:00Z\n\"\",y,p2,2010-01-01T00:00:00Z\n")
    before = spark.conf.get("spark.sql.csv.parser.columnPruning.enabled")
    df = read_csv_table(spark, path, columns=["Member_ID", "Drug_Name"])
    assert sorted(tuple(r) for r in df.collect()) == [("p1", " Lantus "), ("p2", "")]
    assert spark.conf.get("spark.sql.csv.parser.columnPruning.enabled") == before
    with open(f"{path}/2.csv", "w") as f:  # files that come later are seen by the next read
        f.write("Drug_Name,Note,Member_ID,Order_Date\nx,x,p3,2010-01-01T00:00:00Z\n")
    assert read_csv_table(spark, path, columns=["Member_ID"]).count() == 3
    with pytest.raises(ValueError, match="Numeric_Result"):
        read_csv_table(spark, path, columns=["Member_ID", "Numeric_Result"])


def test_appended_files_are_seen_in_one_session(spark):
    from phenoscope.plans.queries import QUERIES

    sf, d = "/root/testdata/sf0.001", tempfile.mkdtemp()
    shutil.copy(f"{sf}/orders.parquet", d)
    spark.read.parquet(f"{sf}/lineitem.parquet").where("l_orderkey % 2 = 0").write.parquet(f"{d}/lineitem.parquet")
    first = QUERIES["med_extract"](spark, d).count()
    spark.read.parquet(f"{sf}/lineitem.parquet").where("l_orderkey % 2 = 1").write.mode("append").parquet(
        f"{d}/lineitem.parquet")
    assert 0 < first < QUERIES["med_extract"](spark, d).count() == QUERIES["med_extract"](spark, sf).count()


def test_criteria_files(spark):
    from phenoscope.sources.criteria import CRITERIA_FILES, read_criteria

    d = tempfile.mkdtemp()
    for name in CRITERIA_FILES:
        with open(f"{d}/{name}.csv", "w") as f:
            f.write("code,description\n250.*,\"any, of it\"\nV77.1,x\nV77.1,again\n\" Lantus\",y\n,empty\n")
    got = sorted(tuple(r) for r in read_criteria(spark, d).where("set_name = 't1dm_med'").collect())
    assert got == [("t1dm_med", "med", "exact", " lantus"), ("t1dm_med", "med", "exact", "v77.1"),
                   ("t1dm_med", "med", "prefix", "250")]


def test_infer_table_name():
    assert infer_table_name("data/x_INPUT.csv") == "x_INPUT"
    assert infer_table_name("a/b.txt") == "txt"
    assert infer_table_name("dir/") == "dir/"


def test_term_set_lines(spark):
    d = tempfile.mkdtemp()
    path = os.path.join(d, "terms.txt")
    with open(path, "wb") as f:
        f.write(b"Lantus\rMETFORMIN\r250.01\nglucatrol \nlantus\nV77.1\n")
    got = sorted(r.term for r in read_term_set(spark, path).collect())
    assert got == ["250.01", "glucatrol ", "lantus", "metformin", "v77.1"]


@pytest.mark.parametrize("fmt", ["tsv", "parquet"])
def test_sinks_round_trip(spark, fmt):
    labels = spark.createDataFrame([("p1", 1), ("p2", 3)], "patient_id string, label int")
    tuples = spark.createDataFrame([("p1", "glucose, serum", 33.3333333333333),
                                    ("p2", "250.00", 2.0), ("p2", " a ", 1.0), ("p2", "a", 1.0),
                                    ("p3", "", 1.0), ("p3", None, 1.0), ("p3", '""', 1.0), ("p3", 'q"x\\', 1.0)],
                                   "patient_id string, feature string, value double")
    d = tempfile.mkdtemp()
    write_labels(labels, f"{d}/labels", fmt)
    write_features(tuples, f"{d}/features", fmt)
    assert sorted(read_labels(spark, f"{d}/labels", fmt).collect()) == sorted(labels.collect())
    assert sorted(read_features(spark, f"{d}/features", fmt).collect(), key=repr) == sorted(
        tuples.collect(), key=repr)
    if fmt == "tsv":
        for bad in ("a\tb", "a\nb", "\\N"):
            with pytest.raises(Exception):
                write_features(spark.createDataFrame([("p", bad, 1.0)], tuples.schema), f"{d}/bad", fmt)


def test_files_of_a_folder_keep_their_own_headers(spark, tmp_path):
    folder = tmp_path / "months_INPUT.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("Member_ID,Order_Date,Drug_Name\n1,2012-01-01T00:00:00Z,actos\n2,d,\"\"\n")
    (folder / "b.csv").write_text("Drug_Name,Member_ID,Note,Order_Date\nlantus,3,n,d3\nbad line\nx,4,n,d4,more\n")
    (folder / "c.csv").write_text("\ufeffMember_ID,Order_Date,Drug_Name\r\n5,,glucophage\r\n")
    (folder / "empty.csv").write_text("")
    names = ("Member_ID", "Order_Date", "Drug_Name")
    df = read_csv_table(spark, str(folder), columns=names)
    assert df.columns == list(names)
    rows = sorted(map(tuple, df.collect()))
    assert rows == [("1", "2012-01-01T00:00:00Z", "actos"), ("2", "d", ""), ("3", "d3", "lantus"),
                    ("5", None, "glucophage")]
    assert df.count() == 4 and [r[0] for r in df.select("Drug_Name").collect()].count("lantus") == 1
    rejected = spark.table("months_INPUT_rejected")
    assert sorted(r.line for r in rejected.collect()) == ["bad line", "x,4,n,d4,more"] and rejected.count() == 2
    assert {r.file.rsplit("/", 1)[1] for r in rejected.collect()} == {"b.csv"}
    whole = read_csv_table(spark, str(folder))
    assert set(whole.columns) == {*names, "Note"} and whole.count() == 4
    with pytest.raises(ValueError, match="no column Note"):
        read_csv_table(spark, str(folder), columns=("Member_ID", "Note"))


def test_compressed_files_and_empty_folders(spark, tmp_path):
    folder = tmp_path / "z_INPUT.csv"
    df = spark.createDataFrame([("1", "a"), ("2", None)], "k string, v string")
    df.coalesce(1).write.option("header", "true").option("compression", "gzip").csv(str(folder))
    assert sorted(map(tuple, read_csv_table(spark, str(folder), columns=("v", "k")).collect()), key=repr) == [
        ("a", "1"), (None, "2")]
    (tmp_path / "none").mkdir()
    assert read_csv_table(spark, str(tmp_path / "none"), columns=("k",)).collect() == []


def test_staging_computes_each_raw_extract_once(spark, monkeypatch):
    from pyspark.sql import functions as F

    from phenoscope.plans import queries
    from phenoscope.plans.context import Events

    computed = spark.sparkContext.accumulator(0)

    def seen(code):
        computed.add(1)
        return code

    raw = spark.createDataFrame([(str(i), f"c{i % 3}" if i % 5 else None) for i in range(40)], "Encounter_ID string, code string")
    raw = raw.select("Encounter_ID", F.udf(seen)("code").alias("code"))
    monkeypatch.setattr(queries, "load_events", lambda *_: Events({"encounter_dx_INPUT": raw}))
    back = queries._staged_csv(spark, "", ["encounter_dx_INPUT"])["encounter_dx_INPUT"]
    assert computed.value == 40
    assert sorted((int(r.Encounter_ID), r.code) for r in back.collect()) == [
        (i, f"c{i % 3}" if i % 5 else None) for i in range(40)]
    assert spark.table("encounter_dx_INPUT_rejected").count() == 4
