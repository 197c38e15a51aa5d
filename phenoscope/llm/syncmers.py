"""Document fingerprints from closed syncmers.

A k-mer (``K`` characters) is an anchor if the smallest hash among its ``S``-character
substrings stands at its first or last place.  That depends on the k-mer alone,
so equal passages give equal anchors whatever surrounds them, and in random text
one place in (K - S + 1) / 2 is an anchor.

The fingerprint of a text holds the distinct hashes of its anchors below ``BOUND``, one in
``DENSITY``, and at least the ``SKETCH`` smallest, as hexadecimal digits in the order of
their first places: it grows with the text.  A text without an anchor (shorter than a few
k-mers) has the hash of the whole text, an empty one nothing.  The likeness of two
fingerprints estimates the share of common anchors that stand in the same order: of the
hashes up to the largest that both would hold, the longest run of common ones that
rises in both, as a share of all.  Two empty fingerprints are alike (1), an empty one
and another are not (0).

Each document is also compared with its successor in descending order of the ids
(after the last the first; null ids last; equal ids by their texts).  Ids are cut into
blocks at quantiles, as many as the table needs; a block is a partition of the one shuffle,
which brings it together with a copy of its successor, the next block's first row, and is
read in order with two texts in memory.  Rows of one id, and rows without an id, are in one
block; Spark sorts it, spilling, so its size costs time but no memory.

A null text counts as empty.  Repeated rows follow each other like other rows.  An
empty table gives an empty result; a single row follows itself.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, strings

K = 20
S = 10
SKETCH = 64
#: One anchor in so many is kept, whatever the length of the text.
DENSITY = 16
BOUND = (1 << 64) // DENSITY
#: Characters of a text that are hashed at a time.
PIECE = 1 << 20
#: A block has about so many rows at most; smaller tables are cut into one block per
#: shuffle partition of the session, of so many rows at least.
BLOCK_ROWS = 200_000
LEAST_ROWS = 1_000
#: Results, and characters of their texts, that are in memory at a time.
RESULTS = 500
RESULT_CHARS = 1 << 23


def anchors(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the closed syncmers of ``text``."""
    if len(text) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)

    def grams(x, width, have):
        """Hashes of ``width`` characters from those of ``have``, in shift-and-mix steps."""
        while have < width:
            step = min(have, width - have)
            x = x[:-step] * np.uint64(0xD6E8FEB86659FD93) + (x[step:] ^ np.uint64(step))
            x ^= x >> np.uint64(32)
            have += step
        return x

    small = grams(h, s, 1)
    wide = k - s + 1
    low, n = small, 1
    while 2 * n <= wide:
        low, n = np.minimum(low[:-n], low[n:]), 2 * n
    if n < wide:
        low = np.minimum(low[:len(low) - (wide - n)], low[wide - n:])
    at = np.flatnonzero((small[:len(low)] == low) | (small[wide - 1:] == low))
    return at, grams(small, k, s)[at]


def fingerprint(text: str | None, k: int = K, s: int = S, size: int = SKETCH) -> str:
    """16 hexadecimal digits per hash."""
    if not text:
        return ""
    found, places = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for a in range(0, max(1, len(text) - k + 1), PIECE):
        at, hashes = anchors(text[a:a + PIECE + k - 1], k, s)
        found, first = np.unique(np.concatenate((found, hashes)), return_index=True)
        n = max(size, int(np.searchsorted(found, np.uint64(BOUND))))
        found, places = found[:n], np.concatenate((places, at + a))[first[:n]]
    if not len(found):
        return f"{xxhash.xxh3_64_intdigest(text.encode('utf-8', 'surrogatepass')):016x}"
    return found[np.argsort(places)].astype(">u8").tobytes().hex()


def likeness(a: str, b: str, size: int = SKETCH) -> float:
    if a == b:
        return 1.0
    x, y = ([f[i:i + 16] for i in range(0, len(f), 16)] for f in (a, b))
    if not x or not y:
        return 0.0
    # a sketch that is not full holds all hashes of its text, another all up to a limit
    limit = min((max(max(h), f"{BOUND - 1:016x}") if len(h) >= size else "g" for h in (x, y)))
    x, y = ([h for h in f if h <= limit] for f in (x, y))
    place = {h: i for i, h in enumerate(x)}
    rising: list[int] = []
    common = 0
    for h in y:
        i = place.get(h)
        if i is not None:
            common += 1
            at = bisect_left(rising, i)
            rising[at:at + 1] = [i]
    return len(rising) / (len(x) + len(y) - common)


def _blocks(docs: DataFrame, rows: int | None) -> tuple[np.ndarray, list]:
    """Quantiles that cut the ids into blocks, and the largest id of each block (None:
    a block of nulls); both grow with the number of blocks only."""
    counted = docs.agg(F.count("*").alias("n"), F.count("id").alias("ids"))
    n, ids = counted.first()
    at_once = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = -(-n // rows) if rows else max(-(-n // BLOCK_ROWS), min(at_once, -(-n // LEAST_ROWS)))
    cuts = np.zeros(0)
    if ids and many > 1:
        shares = [i / many for i in range(1, many)]
        exact = max(10_000, 10 * many)
        cuts = np.unique(docs.agg(F.percentile_approx("id", shares, exact)).first()[0])
    tops = docs.groupBy(_block_of(cuts).alias("b")).agg(F.max("id").alias("top")).collect()
    return cuts, sorted(((r["b"], r["top"]) for r in tops), reverse=True)


def _block_of(cuts: np.ndarray) -> Column:
    """The block of an id, found by binary search; larger ids have larger blocks, and ids
    that are null, last in descending order, have block 0.  Only ids travel to Python."""
    @F.pandas_udf("int")
    def below(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids.to_numpy()) + 1, dtype="int32")

    known = F.col("id").isNotNull()
    least = cuts[0].item() if len(cuts) else 0
    return F.when(known, below(F.coalesce("id", F.lit(least)))).otherwise(0)


def _compare(edit, with_print, out_names):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, rows, held = None, [], 0

        def result(own, following):
            _, _, i, text, fp = own
            edited = edit(text, following[3])
            other = fp if edited == text else with_print(edited)
            return (i, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                    fp, other, likeness(fp, other), likeness(fp, following[4]))

        def packed():
            columns = list(zip(*rows))
            types = (None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) if t else pa.array(c, id_type)
                                               for c, t in zip(columns, types)], out_names)

        for batch in batches:
            id_type = batch.column(batch.schema.get_field_index("id")).type
            for block, extra, i, text in zip(*(strings(batch, c) for c in ("block", "extra", "id", "text"))):
                text = text or ""
                same_text = before is not None and before[3] == text
                now = (block, extra, i, text, before[4] if same_text else with_print(text))
                if before is not None and before[0] == block and not before[1]:
                    rows.append(result(before, now))
                    held += len(before[3])
                    if len(rows) >= RESULTS or held >= RESULT_CHARS:
                        yield packed()
                        rows.clear()
                        held = 0
                before = now
        if rows:
            yield packed()

    return read


def edited_text(text: str, following: str) -> str:
    """The last third of the characters replaced by as many of the next text."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def compare_with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      block_rows: int | None = None) -> DataFrame:
    """One row per document: id, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited`` and ``near_next``.  ``block_rows``: rows of a
    block, about, in place of the module's sizes."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    cuts, tops = _blocks(rows.select("id"), block_rows)
    schema = docs.select(F.col(doc_id).alias("doc_id")).schema
    for name, kind in (("n_chars", "long"), ("edited_sha256", "string"), ("fingerprint", "string"),
                       ("edited_fingerprint", "string"), ("near_edited", "double"), ("near_next", "double")):
        schema = schema.add(name, kind)
    if not tops:
        return docs.sparkSession.createDataFrame([], schema)
    # the first rows of a block also follow the block before it (of larger ids)
    order = [b for b, _ in tops]
    links = {top: order[k - 1] for k, (_, top) in enumerate(tops)}
    none_follows = links.pop(None, None)
    give = docs.sparkSession.createDataFrame(
        [(top, b) for top, b in links.items()], rows.select("id").schema.add("_phx_to", "integer"))
    first_rows = rows.join(F.broadcast(give), "id").select(
        F.col("_phx_to").alias("block"), F.lit(True).alias("extra"), "id", "text")
    all_rows = rows.select(_block_of(cuts).alias("block"), F.lit(False).alias("extra"), "id", "text")
    all_rows = all_rows.unionByName(first_rows)
    if none_follows is not None:
        all_rows = all_rows.unionByName(rows.where("id is null").orderBy(
            F.col("text").asc_nulls_first()).limit(1).select(
            F.lit(none_follows).alias("block"), F.lit(True).alias("extra"), "id", "text"))
    in_order = all_rows.repartitionById(len(cuts) + 2, F.col("block")).sortWithinPartitions(
        "block", "extra", F.col("id").desc_nulls_last(), F.col("text").asc_nulls_first())
    return in_order.mapInArrow(_compare(edited_text, fingerprint, schema.names), schema)


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(read_table(spark, sf_dir, "documents"))
