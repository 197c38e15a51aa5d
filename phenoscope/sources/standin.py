"""Raw clinical extracts derived from the driver's tables.

There is no clinical data in the test tables, so the four raw CSV extracts the
pipeline reads (encounters, encounter diagnoses, medication orders, lab
results; every column a string) are derived from ``orders`` and ``lineitem``
with integer arithmetic that DuckDB reproduces exactly:

* an order is an encounter of patient ``o_custkey`` at ``o_orderdate``;
* a line item picks its event kind by ``l_returnflag`` (``R`` diagnosis,
  ``A`` medication order, ``N`` lab result) and its name by the hash
  ``h = (l_orderkey*31 + l_partkey*17 + l_linenumber*7) % 1000``;
* names are upper-cased when ``h`` is even (loading lower-cases them);
* names with outer blanks and their plain forms both occur (``glucatrol ``);
* medication orders with ``h < 140`` are dated to the start of their year, so the
  first orders of two drug classes tie;
* instants are ISO text with zone ``Z``, or shifted two hours with ``+02``
  when ``h % 3 = 0`` (the same instant);
* lab numbers are cents ``c = l_quantity*400 + h % 100`` (times 1000 when
  ``h % 7 = 0``, giving thousands separators), empty when ``h % 10 = 0`` and
  NULL when ``h % 100 = 55``.

Every rule here is a projection or the one ``orders ⋈ lineitem`` equi-join, so
the extracts scale with the tables they come from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_TABLE_NAMES = ("encounter_INPUT", "encounter_dx_INPUT", "medication_orders_INPUT",
                   "lab_results_INPUT")

# Fixed values of the stand-in: (upper bound of h, name) in order; the rest
# fall through to the generic name given after each table.
DX_BY_HASH = (
    (3, "250.01"), (6, "250.13"), (18, "250.00"), (26, "250.02"), (30, "790.29"),
    (33, "250.10"), (36, "V77.1"), (38, "648.00"), (44, "code2"),
)
DX_OTHER = ("d", 40)  # 'd' || h % 40
MED_BY_HASH = (
    (20, "insulin nph"), (40, "lantus"), (65, "metformin"), (90, "glipizide"),
    (95, "insulin glargine"), (110, " insulin glargine"), (125, "glucatrol "), (140, "glucatrol"),
)
# orders below this hash are dated to the start of their year, so first orders tie
MED_TIED_BELOW = 140
MED_OTHER = ("m", 25)
LAB_BY_HASH = (
    (20, "glucose"), (35, "fasting glucose"), (50, "glucose, serum"), (70, "hba1c"),
)
LAB_OTHER = ("l", 15)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_hash() -> Column:
    return (F.col("l_orderkey") * 31 + F.col("l_partkey") * 17 + F.col("l_linenumber") * 7) % 1000


def _name_by_hash(h: Column, table, other) -> Column:
    prefix, modulus = other
    expr = F.concat(F.lit(prefix), (h % modulus).cast("string"))
    for bound, name in reversed(table):
        expr = F.when(h < bound, F.lit(name)).otherwise(expr)
    return F.when(h % 2 == 0, F.upper(expr)).otherwise(expr)


def _wall_clock(ts: Column) -> Column:
    # a TIMESTAMP_NTZ renders as 'yyyy-MM-dd HH:mm:ss' (no zone conversion)
    return F.translate(ts.cast("string"), " ", "T")


def _iso_text(ts: Column, h: Column) -> Column:
    shifted = F.when(h % 3 == 0, ts + F.make_dt_interval(F.lit(0), F.lit(2))).otherwise(ts)
    zone = F.when(h % 3 == 0, F.lit("+02")).otherwise(F.lit("Z"))
    return F.concat(_wall_clock(shifted), zone)


def _number_text(h: Column) -> Column:
    base = F.col("l_quantity").cast("bigint") * 400 + h % 100
    c = F.when(h % 7 == 0, base * 1000).otherwise(base)
    cents = F.lpad((c % 100).cast("string"), 2, "0")
    # c stays far below 2**53, so floor of the double quotient is exact
    big = F.concat(
        F.floor(c / 100000).cast("bigint").cast("string"),
        F.lit(","),
        F.lpad((F.floor(c / 100) % 1000).cast("bigint").cast("string"), 3, "0"),
        F.lit("."),
        cents,
    )
    small = F.concat(F.floor(c / 100).cast("bigint").cast("string"), F.lit("."), cents)
    text = F.when(c >= 100000, big).otherwise(small)
    return (
        F.when(h % 10 == 0, F.lit(""))
        .when(h % 100 == 55, F.lit(None).cast("string"))
        .otherwise(text)
    )


def _lines_with_patient(spark: SparkSession, sf_dir: str, flag: str) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == flag)
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")


def raw_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("Encounter_ID"),
        F.col("o_custkey").cast("string").alias("Member_ID"),
        F.concat(_wall_clock(F.col("o_orderdate")), F.lit("Z")).alias("Encounter_DateTime"),
    )


def raw_encounter_dx(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    h = line_hash()
    return li.select(
        F.col("l_orderkey").cast("string").alias("Encounter_ID"),
        _name_by_hash(h, DX_BY_HASH, DX_OTHER).alias("code"),
    )


def raw_medication_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = line_hash()
    date = F.col("l_shipdate").cast("timestamp_ntz")
    year = F.date_trunc("year", date).cast("timestamp_ntz")
    return _lines_with_patient(spark, sf_dir, "A").select(
        F.col("o_custkey").cast("string").alias("Member_ID"),
        _iso_text(F.when(h < MED_TIED_BELOW, year).otherwise(date), h).alias("Order_Date"),
        _name_by_hash(h, MED_BY_HASH, MED_OTHER).alias("Drug_Name"),
    )


def raw_lab_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = line_hash()
    return _lines_with_patient(spark, sf_dir, "N").select(
        F.col("o_custkey").cast("string").alias("Member_ID"),
        _iso_text(F.col("l_shipdate"), h).alias("Date_Collected"),
        _name_by_hash(h, LAB_BY_HASH, LAB_OTHER).alias("Result_Name"),
        _number_text(h).alias("Numeric_Result"),
    )


#: The four raw extracts, keyed by the file stem the original loader used.
RAW_TABLES = {
    "encounter_INPUT": raw_encounters,
    "encounter_dx_INPUT": raw_encounter_dx,
    "medication_orders_INPUT": raw_medication_orders,
    "lab_results_INPUT": raw_lab_results,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All raw extracts, keyed by file stem."""
    return {stem: make(spark, sf_dir) for stem, make in RAW_TABLES.items()}
