"""Helpers shared by the operators: text slices of bounded size, written tables
in the shared folder, and connected components of a link table."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Texts are handed to NumPy in slices of about this many characters.
SLICE_CHARS = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and reread: cuts
    the lineage and survives the loss of the executors that computed it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_slices(lengths, limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose lengths sum to about ``limit``; a longer row is alone."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def strings(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns by name as Spark compares names (case-insensitive)."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def any_of(conditions) -> Column:
    return functools.reduce(lambda x, y: x | y, conditions)


def connected_components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` → ``(node, root)``: the smallest node that each linked node
    can reach.  Nodes without a link are absent.

    Alternating star contraction: each round hooks a node's larger neighbours
    to its smallest one (large star), then all of its smaller neighbours to the
    smallest (small star); the rounds grow with the logarithm of the diameter.
    A node's minimum is a pre-aggregated ``min`` and its neighbours stay rows
    of a join that AQE can split, so no neighbour list is ever gathered.
    """
    edges = written(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(), "links")
    before = None
    while True:
        both = edges.select("u", "v").unionByName(
            edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v")))
                 .where("u <> v").distinct())
        edges = written(small, "links")
        # a fixed point is a star forest: its digest no longer changes
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            return (edges.groupBy("u").agg(F.min("v").alias("root"))
                    .select(F.col("u").alias("node"), "root")
                    .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))
                                 .distinct()))
        before = tuple(now)
