"""Suffix-array dedup: removes bytes of repeated strings by threshold-bounded
interval expansion on a Burrows-Wheeler transform.

A byte goes if a string of ``length`` bytes covers it that also starts earlier
(smaller id, or the same document, earlier start).

1. Every ``length``-byte window belongs to the smallest hash among its
   ``GRAM``-byte grams.  Equal windows have equal smallest hashes, so neighbouring windows
   of one smallest hash form a run, and only runs of equal hash can share a window.
   Runs are shuffled by that hash (hash, place; no text).  Runs of equal content count as
   one from the first batch on, so a text with millions of copies arrives once per
   batch; all but the first run of a content are repeats as a whole.
2. Where the runs of a hash differ in content (or a run meets its own hash again),
   the distinct ones fetch their text and are dealt by hash into buckets of
   ``BUCKET_BYTES``; where one hash has too many, a second hash of the windows
   deals them out.  Any other run shares its windows with exact copies only.
3. A bucket sorts its suffixes to the threshold's depth, takes the transform, and
   derives the common prefixes in increasing order: the interval of the empty
   string is extended backward by every character, level by level; an interval whose
   right border is new has that level as the common prefix there, and only
   such intervals are extended again.  At the threshold it stops: borders not
   met by then separate equal windows.
4. Of the equal windows all but the first are repeats; their spans are cut.

A null text counts as empty.  Ids are integers; null ids come after all others.  Rows
that repeat an id and its text are one document and are treated alike.  An empty table
gives an empty result; further columns are kept, but for the result's own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import broadcast_if_small
from .common import read_table, same, strings, without, written

LENGTH = 100
GRAM = 32
#: Text that a bucket sorts at a time, and bytes of a text that are hashed at a time.
BUCKET_BYTES = 3 << 19
PIECE = 2 << 20
#: Runs are shuffled with start and windows in one number, and these flags in another.
N_BITS = PIECE.bit_length()
NONE, AGAIN, KNOWN = 1, 2, 4
#: Where the different runs of one hash have more bytes, a second hash deals them out.
HOT_BYTES = 4 * BUCKET_BYTES


def window_runs(data: bytes, length: int = LENGTH, seed: int = 0):
    """Runs ``(start, windows, smallest hash, whether the hash meets itself)``."""
    b, gram = np.frombuffer(data, np.uint8), min(GRAM, 1 << (length.bit_length() - 2))
    wide = length - gram + 1
    h = (b.astype(np.uint64) + np.uint64(1 + 256 * seed)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    step = 1
    while step < gram:
        h = h[:-step] * np.uint64(0xD6E8FEB86659FD93) + (h[step:] ^ np.uint64(step))
        h ^= h >> np.uint64(32)
        step *= 2

    def sliding(x, width, pick):
        n = 1
        while 2 * n <= width:
            x, n = pick(x[:-n], x[n:]), 2 * n
        return pick(x[:len(x) - (width - n)], x[width - n:]) if n < width else x

    low = sliding(h, wide, np.minimum)
    start = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
    value = low[start]
    # a gram is some window's smallest if it equals the largest minimum around it
    edge = np.zeros(wide - 1, np.uint64)
    around = sliding(np.concatenate((edge, low, edge)), wide, np.maximum)
    chosen = h[around == h]
    again = np.isin(value, chosen[1:][chosen[1:] == chosen[:-1]])
    return start, np.diff(np.append(start, len(low))), value.view(np.int64), again


def _runs(length: int):
    names = ["m", "c", "id", "row", "an", "flags"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, contents = [], []
            texts = strings(batch, "data")
            for i, data in enumerate(texts):
                if data is None:
                    continue
                for at in range(0, len(data) - length + 1, PIECE):
                    piece = data[at:at + PIECE + length - 1]
                    start, n, value, again = window_runs(piece, length)
                    parts.append((np.full(len(start), i), start + at, n, value, again))
                    contents += [xxhash.xxh3_64_intdigest(piece[s:s + k + length - 1])
                                 for s, k in zip(start.tolist(), n.tolist())]
            if not parts:
                continue
            doc, a, n, m, again = (np.concatenate(x) for x in zip(*parts))
            c = np.array(contents, np.uint64).view(np.int64)
            none = np.array([x is None for x in strings(batch, "id")])
            ids = np.array([x or 0 for x in strings(batch, "id")], np.int64)
            row = batch.column(batch.schema.get_field_index("row")).to_numpy()
            order = np.lexsort((a, row[doc], ids[doc], none[doc], c, m))
            doc, a, n, m, c, again = (x[order] for x in (doc, a, n, m, c, again))
            known = np.concatenate(([False], (m[1:] == m[:-1]) & (c[1:] == c[:-1])))
            place = np.stack((none[doc], ids[doc], row[doc], a))
            same_place = np.concatenate(([False], (place[:, 1:] == place[:, :-1]).all(axis=0)))
            known &= ~same_place  # a repeated row
            keep = known | ~same_place
            flags = none[doc] * NONE + again * AGAIN + known * KNOWN
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[keep]) for x in (m, c, ids[doc], row[doc], a << N_BITS | n, flags)], names)

    return find


def _groups(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[dict]:
    """Sorted batches cut so that rows of equal ``name`` stay together."""
    held: list[pa.RecordBatch] = []

    def joined():
        table = pa.Table.from_batches(held).combine_chunks()
        return {k: table.column(k).to_numpy() for k in table.column_names}

    for batch in batches:
        key = batch.column(batch.schema.get_field_index(name)).to_numpy()
        last = int(np.searchsorted(key, key[-1])) if len(key) else 0
        if last:
            held.append(batch.slice(0, last))
            yield joined()
            held = []
        elif held and len(key) and held[-1].column(held[-1].schema.get_field_index(name))[-1].as_py() != key[0]:
            yield joined()
            held = []
        if len(key):
            held.append(batch.slice(last))
    if held:
        yield joined()


def _sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs in the order of their hash → repeats as a whole (``whole``) and the first
    run of each content that may share a window with another."""
    for x in _groups(batches, "m"):
        x["none"] = x["flags"] & NONE
        x["a"], x["n"] = x["an"] >> N_BITS, x["an"] & ((1 << N_BITS) - 1)
        order = np.lexsort((x["a"], x["row"], x["id"], x["none"], x["c"], x["m"]))
        x = {k: v[order] for k, v in x.items()}
        new_m = np.concatenate(([True], x["m"][1:] != x["m"][:-1]))
        new_c = new_m | np.concatenate(([True], x["c"][1:] != x["c"][:-1]))
        head = np.flatnonzero(new_m)
        group = np.cumsum(new_m) - 1
        several = np.add.reduceat(new_c.astype(int), head) > 1
        several |= np.bitwise_or.reduceat(x["flags"] & AGAIN, head) > 0
        place = np.stack([x[k] for k in ("none", "id", "row", "a")])
        first_of_c = np.maximum.accumulate(np.where(new_c, np.arange(len(new_c)), 0))
        whole = ~new_c & ~(place == place[:, first_of_c]).all(axis=0)
        # copies go even where the hash has one content, whose first run needs no comparison
        keep = several[group] & new_c | whole
        yield pa.RecordBatch.from_arrays(
            [pa.array(x["m"][keep]), pa.array(x["none"][keep] > 0),
             *[pa.array(x[k][keep]) for k in ("id", "row", "a", "n")], pa.array(whole[keep])],
            ["m", "none", "id", "row", "a", "n", "whole"])


def _fetch(length: int):
    names = ["m", "none", "id", "row", "a", "content"]

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, i, row, wanted in zip(*(strings(batch, k) for k in ("data", "id", "row", "wanted"))):
                rows = []
                for w in wanted:
                    a, content = w["a"], data[w["a"]:w["a"] + w["n"] + length - 1]
                    if not w["hot"]:
                        rows.append((w["m"], i is None, i or 0, row, a, content))
                        continue
                    start, n, second, _ = window_runs(content, length, seed=1)
                    rows += [((w["m"] * 31 ^ x) % (1 << 63), i is None, i or 0, row, a + s,
                              content[s:s + k + length - 1])
                             for s, k, x in zip(start.tolist(), n.tolist(), second.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.bool_(), *[pa.int64()] * 3,
                                                                 pa.binary()))], names)

    return fetch


def bounded_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols; each 0 is a separator
    of its own; equal ones are in the order of their places.

    Prefix doubling: two ranks and the place share one 64-bit number as long as the
    text has up to 2**21 symbols, so each round is a plain sort of numbers."""
    n = len(symbols)
    ends = np.flatnonzero(symbols == 0)
    sizes = np.diff(np.append(-1, ends))
    left = np.repeat(ends, sizes) - np.arange(n)  # symbols before the separator
    present = np.zeros(int(symbols.max()) + 1, np.int64)
    present[symbols] = 1
    dense = (np.cumsum(present) - present[0])[symbols] * (symbols > 0)  # 0 stays 0
    place_bits, symbol_bits = n.bit_length(), int(dense.max()).bit_length()
    have = max(1, min(depth, (63 - place_bits) // max(1, symbol_bits)))
    key = np.zeros(n, np.int64)
    for j in range(have):
        key <<= symbol_bits
        key[:n - j] |= np.where(left[:n - j] > j, dense[j:], 0)
    place = np.arange(n)
    order = np.sort(key << place_bits | place) & ((1 << place_bits) - 1)
    ordered = key[order]
    while True:
        new = np.ones(n, bool)
        new[1:] = (ordered[1:] != ordered[:-1]) | (left[order[1:]] < have)
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        if have >= depth or new.all():
            return order
        step = min(have, depth - have)
        key = rank << 32
        key[:n - step] |= rank[step:]
        if 3 * place_bits <= 63:
            packed = (rank << place_bits | (key & 0xFFFFFFFF)) << place_bits | place
            order = np.sort(packed) & ((1 << place_bits) - 1)
        else:
            order = np.argsort(key, kind="stable")
        ordered = key[order]
        have += step


def borders_below(symbols: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Whether a suffix's common prefix with the one before it in ``order`` is shorter
    than ``depth``: interval expansion on the transform, shortest first."""
    n = len(symbols)
    before = symbols[order - 1]  # the transform; the last symbol is a separator
    step = np.empty(n, np.int32)  # from a suffix's row to that of the suffix one symbol longer
    step[np.argsort(before, kind="stable")] = np.arange(n, dtype=np.int32)
    step[before == 0] = -1
    first = np.sort(symbols)  # the first symbols of the rows
    separators = int(np.searchsorted(first, 1))
    border = np.zeros(n + 1, bool)
    border[[0, n]] = True
    # the empty string's interval, extended by each symbol; separators are all different
    cut = np.concatenate((np.arange(separators), separators + np.flatnonzero(
        np.concatenate(([True], first[separators + 1:] != first[separators:-1])))
        if separators < n else [], [n])).astype(np.int32)
    left, right = cut[:-1], cut[1:]
    border[right] = True
    tag = np.empty(n, np.int32)
    for _ in range(1, depth):
        sizes = right - left
        alone = sizes == 1  # most intervals, once texts differ
        to, wide = step[left[alone]], ~alone
        to, own = to[to >= 0], None
        if wide.any():
            left, sizes = left[wide], sizes[wide]
            own = np.repeat(np.arange(len(left), dtype=np.int32), sizes)
            rows = np.arange(len(own), dtype=np.int32) + np.repeat(
                left - (np.cumsum(sizes, dtype=np.int32) - sizes), sizes)
            many = step[rows]
            text = many >= 0
            many, own = many[text], own[text]
            tag[many] = own
            many.sort()
            start = np.ones(len(many), bool)
            start[1:] = ((many[1:] != many[:-1] + 1) | (tag[many[1:]] != tag[many[:-1]])
                         | (first[many[1:]] != first[many[:-1]]))
            at = np.flatnonzero(start)
            left = np.concatenate((to, many[at]))
            right = np.concatenate((to + 1, many[np.append(at[1:], len(many)) - 1] + 1))
        else:
            left, right = to, to + 1
        new = ~border[right]
        left, right = left[new], right[new]
        border[right] = True
        if not len(left):
            break
    return border[:n]


def repeated_windows(contents: list[bytes], places: np.ndarray, length: int = LENGTH):
    """Windows of the contents that start earlier elsewhere, as runs ``(content,
    offset, windows)``.  ``places``: none, id, row and start of each content."""
    sizes = np.array([len(x) for x in contents]) + 1
    symbols = np.zeros(int(sizes.sum()), np.uint16)
    text = np.ones(len(symbols), bool)
    last = np.cumsum(sizes) - 1
    text[last] = False
    symbols[text] = np.frombuffer(b"".join(contents), np.uint8).astype(np.uint16) + 1
    order = bounded_order(symbols, length)
    border = borders_below(symbols, order, length)
    owner = np.repeat(np.arange(len(contents)), sizes)
    offset = np.arange(len(symbols)) - (last - sizes + 1)[owner]
    group = np.cumsum(border) - 1
    alone = np.bincount(group) < 2
    rows = np.flatnonzero(~alone[group])
    at, group = order[rows], group[rows]
    none, ids, row, a = (p[owner[at]] for p in places)
    sort = np.lexsort((a + offset[at], row, ids, none, group))
    at, group = at[sort], group[sort]
    place = np.stack((none[sort], ids[sort], row[sort], (a + offset[order[rows]])[sort]))
    head = np.concatenate(([True], group[1:] != group[:-1]))
    first = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
    later = at[~(place == place[:, first]).all(axis=0)]
    later.sort()
    start = np.flatnonzero(np.concatenate(([True], later[1:] != later[:-1] + 1))) if len(later) else later
    return owner[later[start]], offset[later[start]], np.diff(np.append(start, len(later)))


def _expand(length: int):
    names = ["none", "id", "row", "a", "n"]

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _groups(batches, "bucket"):
            # buckets that a batch holds as a whole are taken one by one
            cut = np.flatnonzero(np.concatenate(([True], x["bucket"][1:] != x["bucket"][:-1], [True])))
            for lo, hi in zip(cut[:-1], cut[1:]):
                places = [x[k][lo:hi] for k in ("none", "id", "row", "a")]
                own, offset, n = repeated_windows(x["content"][lo:hi].tolist(), places, length)
                if len(own):
                    out = [p[own] for p in places]
                    out[3] = out[3] + offset
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*out, n)], names)

    return expand


def repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs(id, row, data)`` → ``(none, id, row, spans)``: of the documents that have
    repeated windows, the runs ``(a, n)`` of their starts."""
    runs = (docs.where(F.octet_length("data") >= length).mapInArrow(
        _runs(length), "m long, c long, id long, row long, an long, flags long"))
    # known repeats go past the comparison, spread over all partitions
    key = F.when(F.col("flags").bitwiseAND(KNOWN) > 0, F.xxhash64("row", "an")).otherwise(F.col("m"))
    sorted_runs = (runs.withColumn("m", key).repartition("m")
                   .sortWithinPartitions("m"))
    fields = "m long, none boolean, id long, row long, a long, n long, whole boolean"
    sifted = written(sorted_runs.mapInArrow(_pass_known(_sift), fields), "runs")
    apart = sifted.where("not whole")
    total = apart.agg(F.sum(F.col("n") + length)).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    # a hash that very many different runs share (a common phrase) must not fill a bucket
    hot = (apart.groupBy("m").agg(F.sum(F.col("n") + length).alias("bytes")).where(F.col("bytes") > HOT_BYTES)
           .select("m", F.lit(True).alias("hot")))
    apart = apart.join(broadcast_if_small(hot), "m", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    wanted = apart.groupBy("none", "id", "row").agg(F.collect_list(F.struct("m", "a", "n", "hot")).alias("wanted"))
    found = (_with_rows(docs, wanted, "inner").select("id", "row", "data", "wanted")
             .mapInArrow(_fetch(length), "m long, none boolean, id long, row long, a long, content binary")
             .withColumn("bucket", F.pmod("m", F.lit(buckets)))
             .repartition("bucket").sortWithinPartitions("bucket")
             .mapInArrow(_expand(length), "none boolean, id long, row long, a long, n long"))
    return (sifted.where("whole").select("none", "id", "row", "a", "n").unionByName(found)
            .groupBy("none", "id", "row").agg(F.collect_list(F.struct("a", "n")).alias("spans")))


def _pass_known(sift):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fresh():
            for batch in batches:
                column = {k: batch.column(batch.schema.get_field_index(k)) for k in batch.schema.names}
                flags, an = column["flags"].to_numpy(), column["an"].to_numpy()
                known = (flags & KNOWN) > 0
                if known.any():
                    passed.append(pa.RecordBatch.from_arrays(
                        [pa.array(x[known]) for x in (column["m"].to_numpy(), (flags & NONE) > 0,
                                                      column["id"].to_numpy(), column["row"].to_numpy(),
                                                      an >> N_BITS, an & ((1 << N_BITS) - 1), known)],
                        ["m", "none", "id", "row", "a", "n", "whole"]))
                yield batch.filter(pa.array(~known))

        passed: list[pa.RecordBatch] = []
        for out in sift(fresh()):
            yield from passed
            passed.clear()
            yield out
        yield from passed

    return run


def _with_rows(docs: DataFrame, of: DataFrame, how: str) -> DataFrame:
    """``of(none, id, row, ...)`` joined to ``docs(id, row, ...)``."""
    of = of.withColumn("id", F.when(~F.col("none"), F.col("id"))).drop("none")
    of = of.withColumnsRenamed({"id": "_phx_id", "row": "_phx_row"})
    return docs.join(of, same(docs["id"], of["_phx_id"]) & (docs["row"] == of["_phx_row"]), how).drop(
        "_phx_id", "_phx_row")


def _cut(length: int, names: list[str]):
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, kept = [], []
            for data, runs in zip(strings(batch, "data"), strings(batch, "spans")):
                data, merged = data or b"", []
                for a, e in sorted((r["a"], r["a"] + r["n"] + length - 1) for r in runs or ()):
                    if merged and a <= merged[-1]["end"]:
                        merged[-1]["end"] = max(merged[-1]["end"], e)
                    else:
                        merged.append({"start": a, "end": e})
                borders = [0, *(p for s in merged for p in (s["start"], s["end"])), len(data)]
                spans.append(merged)
                kept.append(b"".join(data[a:b] for a, b in zip(borders[::2], borders[1::2])))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(c)) for c in names],
                 pa.array(spans, span), pa.array(kept, pa.binary())], [*names, "removed", "kept"])

    return cut


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   length: int = LENGTH) -> DataFrame:
    """``docs`` with ``removed``, the byte spans that go, and ``kept``, the bytes left."""
    inputs = without(docs, "removed", "kept")
    row = F.coalesce(F.xxhash64(text), F.lit(0))
    data = F.col(text).cast("binary")
    bare = docs.select(F.col(doc_id).cast("long").alias("id"), row.alias("row"), data.alias("data"))
    found = repeats(bare, length)
    found = found.select(F.when(~F.col("none"), F.col("id")).alias("_phx_id"),
                         F.col("row").alias("_phx_row"), "spans")
    names = inputs.columns
    whole = inputs.select(*[F.col(f"`{c}`") for c in names], data.alias("_phx_data"), row.alias("_phx_own"))
    joined = whole.join(found, same(F.col(doc_id).cast("long"), F.col("_phx_id"))
                        & (F.col("_phx_own") == F.col("_phx_row")), "left")
    joined = joined.select(*[F.col(f"`{c}`").alias(f"_phx_{i}") for i, c in enumerate(names)],
                           F.col("_phx_data").alias("data"), "spans")
    numbered = [f"_phx_{i}" for i in range(len(names))]
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = joined.select(*numbered).schema.add("removed", T.ArrayType(span)).add("kept", "binary")
    out = joined.mapInArrow(_cut(length, numbered), schema)
    return out.select(*[F.col(f"_phx_{i}").alias(c) for i, c in enumerate(names)], "removed", "kept")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = remove_repeats(docs)
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return cut.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        n_removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))
