"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints are within 2r bits of each other exactly when some 64-bit value
lies within r bits of both.  So every distinct fingerprint emits all its variants
of up to r changed bits, variants meet in a shuffle, and the fingerprints that
share one are linked.

The variants are dealt out by their lowest bits, as many (the depth) as the number of
fingerprints needs.  All variants of a fingerprint that go to one bucket travel as the
fingerprint itself, and only buckets within r bits of its own lowest ones get it: with
r = 2 and depth d these are 1 + d + d(d - 1)/2 of 2**d.  How many each bucket will get is
counted first, from the lowest bits alone; a bucket that would get more than
``BUCKET_PRINTS`` (fingerprints of a large family agree in many bits) is split by further
bits until none does, so no group grows with the corpus.  A bucket lists its variants
a slice at a time, by a linear syndrome of all bits.  Fingerprints that share a
variant are all linked to the smallest of them (they are within 2r bits of it, which
is verified), and a bucket hands on a spanning forest of its links, never all pairs.

Copies have one fingerprint and are one node.  A text without a word (null, empty,
only white space) has fingerprint zero and is linked like any other.  Ids that are null
belong to their group but do not name it, unless it has no other.  Repeated rows
get equal results; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import broadcast_if_small
from .common import connected_components, read_table, strings, written

#: The contract's shingle length and maximum bit distance.
SHINGLE = 4
DISTANCE = 4
#: Lowest bits that variants are dealt by, at least; variants that a bucket lists on average
#: and fingerprints that it gets, at most; bits by which a larger one is split; and bits
#: after which a bucket can hold no more than a few balls' fingerprints.
LEAST_DEPTH = 5
BUCKET_VARIANTS = 1 << 25
BUCKET_PRINTS = 1 << 22
SPLIT_BITS = 4
DEEPEST = 60
#: Fingerprints that are dealt out at a time.
DEALT = 1 << 12
#: Variants that are in memory at a time.
SLICE_VARIANTS = 1 << 21
#: Bytes of a text that are cut into words at a time.
PIECE = 1 << 22
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _word_lists(data: bytes, width: int) -> Iterator[list[bytes]]:
    """Lower-cased words in lists that overlap by width - 1 words."""
    at, carry = 0, []
    while at < len(data):
        cut = len(data)
        if len(data) - at > 2 * PIECE:
            found = _SPACE.search(data, at + PIECE)
            cut = found.start() if found else cut
        words = carry + data[at:cut].lower().split()
        at = cut
        if at < len(data) and len(words) < width:
            carry = words
            continue
        yield words
        carry = words[len(words) - width + 1:] if width > 1 else []


def simhash(text: str | None, width: int = SHINGLE) -> int:
    """64-bit fingerprint of the word shingles, repeats included."""
    set_bits, total = np.zeros(64, np.int64), 0
    for words in _word_lists((text or "").encode("utf-8", "surrogatepass"), width):
        if not words or (total and len(words) < width):
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        last = ends[min(width, len(words)) - 1:].tolist()
        first = [0, *(ends[:len(last) - 1] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        h = np.array([digest(joined[a:b], 42) for a, b in zip(first, last)], "<u8")
        for part in np.array_split(h, -(-len(h) // 65536)):
            set_bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1,
                                      bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(h)
    return int(np.packbits(2 * set_bits > total, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str, name: str, keep: list[str],
                     width: int = SHINGLE) -> DataFrame:
    """Columns ``keep`` of ``docs`` and the fingerprint, as a signed long ``name``."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([simhash(t, width) for t in strings(batch, text)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(c)) for c in keep],
                 pa.array(prints.view(np.int64))], [*keep, name])

    fields = docs.select(*[f"`{c}`" for c in keep]).schema.add(name, "long")
    return docs.select(*[f"`{c}`" for c in dict.fromkeys([*keep, text])]).mapInArrow(add, fields)


@functools.cache
def _ball(bits: int, radius: int) -> np.ndarray:
    """Changes of up to ``radius`` of the lowest ``bits`` bits."""
    return np.array([sum(1 << p for p in places) for n in range(radius + 1)
                     for places in itertools.combinations(range(bits), n)], np.uint64)


@functools.cache
def _changes(depth: int, fine: int, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Changes of up to ``radius`` bits in the order of their syndromes, these, and the
    syndromes of the bytes (8 × 256): the lowest ``depth`` bits, and above them ``fine``
    sums of bits chosen at random."""
    extra = np.random.RandomState(64).randint(0, 1 << 30, 64) & ((1 << fine) - 1)
    columns = [(1 << p if p < depth else 0) | int(extra[p]) << depth for p in range(64)]
    table = np.zeros((8, 256), np.int64)
    for place in range(64):
        table[place // 8][(np.arange(256) >> place % 8) & 1 == 1] ^= columns[place]
    changes = _ball(64, radius)
    syndromes = _syndrome(changes, table)
    order = np.argsort(syndromes, kind="stable")
    return changes[order], syndromes[order], table


def _syndrome(prints: np.ndarray, table: np.ndarray) -> np.ndarray:
    parts = prints.astype("<u8").view(np.uint8).reshape(-1, 8)
    return functools.reduce(np.bitwise_xor, (table[i][parts[:, i]] for i in range(8)))


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between indexes → (node, smallest node reachable)."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def bucket_links(prints: np.ndarray, bucket: int, bucket_bits: int, radius: int):
    """Links among the distinct sorted ``prints`` by shared variants whose lowest
    ``bucket_bits`` bits are ``bucket``."""
    low = (prints ^ np.uint64(bucket)) & np.uint64((1 << bucket_bits) - 1)
    left = radius - np.bitwise_count(low).astype(int)
    sizes = np.array([len(_ball(64 - bucket_bits, r)) for r in range(radius + 1)])
    listed = int(sizes[left[left >= 0]].sum())
    fine = max(0, (listed // SLICE_VARIANTS).bit_length())
    changes, syndromes, table = _changes(bucket_bits, fine, radius)
    own = _syndrome(prints, table)
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for part in range(1 << fine):
        need = own ^ (bucket | part << bucket_bits)
        starts = np.searchsorted(syndromes, need)
        counts = np.searchsorted(syndromes, need, "right") - starts
        owner = np.repeat(np.arange(len(prints)), counts)
        change = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts - starts, counts)
        variant = prints[owner] ^ changes[change]
        ordered = np.sort(variant)
        shared = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(shared):
            continue
        shared = np.unique(shared)
        hit = shared[np.minimum(np.searchsorted(shared, variant), len(shared) - 1)] == variant
        variant, owner = variant[hit], owner[hit]
        order = np.lexsort((owner, variant))
        variant, owner = variant[order], owner[order]
        head = np.flatnonzero(np.concatenate(([True], variant[1:] != variant[:-1])))
        first = np.repeat(owner[head], np.diff(np.append(head, len(owner))))
        real = np.bitwise_count(prints[owner] ^ prints[first]) <= 2 * radius
        real &= owner != first
        a, b = _forest(np.concatenate((a, owner[real])), np.concatenate((b, first[real])))
    return a, b


def _depth(n: int, radius: int) -> int:
    """Lowest bits to deal ``n`` fingerprints by."""
    ball, depth = len(_ball(64, radius)), LEAST_DEPTH
    while depth < DEEPEST and (n * ball >> depth > BUCKET_VARIANTS
                               or 4 * n * len(_ball(depth, radius)) >> depth > BUCKET_PRINTS):
        depth += 1
    return depth


def _levels(prints: DataFrame, radius: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """``(depth, split, large)``: buckets of ``depth`` bits, of the ``split`` ones of the level
    before (at first: all), of which the ``large`` ones are split at the next level.

    Loads are sums over the counts of equal lowest bits; only the numbers of large
    buckets come to the driver, one for ``BUCKET_PRINTS`` / |ball| fingerprints at most."""
    spark = prints.sparkSession
    rows, depth = prints.select("fp"), _depth(prints.count(), radius)
    levels, split = [], np.zeros(0, np.uint64)
    while True:
        bits = F.lit((1 << depth) - 1)
        near = F.explode(F.lit(_ball(depth, radius).astype(np.int64).tolist())).alias("change")
        loads = (rows.groupBy(F.col("fp").bitwiseAND(bits).alias("low")).agg(F.count("*").alias("n"))
                 .select("n", "low", near)
                 .select("n", F.col("low").bitwiseXOR(F.col("change")).alias("bucket")))
        if levels:
            parents = spark.createDataFrame([(int(x),) for x in split], "parent long")
            before = F.lit((1 << levels[-1][0]) - 1)
            loads = loads.join(broadcast_if_small(parents),
                               F.col("bucket").bitwiseAND(before) == F.col("parent"), "left_semi")
        large = [r["bucket"] for r in loads.groupBy("bucket").agg(F.sum("n").alias("n"))
                 .where(F.col("n") > BUCKET_PRINTS).select("bucket").collect()] if depth < DEEPEST else []
        levels.append((depth, split, np.array(sorted(large), np.uint64)))
        if not large:
            return levels
        around = (spark.createDataFrame([(x,) for x in large], "large long").select("large", near)
                  .select(F.col("large").bitwiseXOR(F.col("change")).alias("low")).distinct())
        rows = rows.join(broadcast_if_small(around), F.col("fp").bitwiseAND(bits) == F.col("low"), "left_semi")
        split, depth = levels[-1][2], min(DEEPEST, depth + SPLIT_BITS)


def dealt(prints: DataFrame, radius: int) -> DataFrame:
    """``prints(fp)`` → ``(bucket, fps)``: fingerprints, 8 bytes each, that have variants in a
    bucket; its number is that of its lowest bits under a leading 1."""
    levels = _levels(prints, radius)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(every), DEALT):
                fp, before = every[at:at + DEALT], 0
                for depth, split, large in levels:
                    near = _ball(depth, radius)
                    bucket = ((fp & np.uint64((1 << depth) - 1))[:, None] ^ near).ravel()
                    owner = np.repeat(np.arange(len(fp)), len(near))
                    if before:
                        mine = np.isin(bucket & np.uint64((1 << before) - 1), split)
                        bucket, owner = bucket[mine], owner[mine]
                    deeper = np.isin(bucket, large)
                    order = np.argsort(bucket[~deeper], kind="stable")
                    number, goes = bucket[~deeper][order], fp[owner[~deeper][order]]
                    if len(number):
                        heads = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1])))
                        offsets = (np.append(heads, len(number)) * 8).astype(np.int32)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array((number[heads] | np.uint64(1 << depth)).view(np.int64)),
                             pa.Array.from_buffers(pa.binary(), len(heads), [
                                 None, pa.py_buffer(offsets), pa.py_buffer(goes.astype("<u8"))])],
                            ["bucket", "fps"])
                    fp, before = fp[np.unique(owner[deeper])], depth
                    if not len(fp):
                        break

    return prints.select("fp").mapInArrow(emit, "bucket long, fps binary")


def fingerprint_links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``prints(fp)``, distinct → ``(a, b)``: links that join all fingerprints within
    ``distance`` (even) bits of each other, directly or through others."""
    if distance % 2:
        raise ValueError("the ball has half the distance as its radius: give an even distance")
    radius = distance // 2

    def meet(table: pa.Table) -> pa.Table:
        fp = np.unique(np.frombuffer(b"".join(table.column("fps").to_pylist()), "<u8"))
        number = table.column("bucket")[0].as_py()
        depth = number.bit_length() - 1
        a, b = bucket_links(fp, number ^ 1 << depth, depth, radius)
        return pa.table([pa.array(fp[a].view(np.int64)), pa.array(fp[b].view(np.int64))], ["a", "b"])

    return dealt(prints, radius).groupBy("bucket").applyInArrow(meet, "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    width: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per document: its id, ``fp`` (signed long), ``component_id``, the
    smallest fingerprint of the component, ``root``, and the hash ``row`` of its text."""
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("row"))
    found = written(with_fingerprint(keyed, "text", "fp", ["doc_id", "row"], width), "prints")
    classes = written(found.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = connected_components(fingerprint_links(classes.select("fp"), distance))
    named = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = named.join(lowest, "root").select("fp", "component_id", "root")
    return found.join(of_print, "fp").select("doc_id", "fp", "component_id", "root", "row")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                         width: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each group of near-duplicates: that of the smallest id.  Rows that
    repeat its id and text count as copies, too.

    Which rows stay is decided on ids and hashes; texts are shuffled once, by the key
    that also finds the rows that repeat the one that stays."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    keep = (near_duplicates(docs, doc_id, text, width, distance).groupBy("root").agg(first)
            .select(F.struct("first.doc_id", "first.row").alias("_phx_key")))
    # a struct is never null, so null ids meet in a plain equality
    key = F.struct(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("row")).alias("_phx_key")
    columns = [f"`{c}`" for c in docs.columns]
    return (docs.select(*columns, key).join(keep.hint("merge"), "_phx_key", "left_semi")
            .dropDuplicates(["_phx_key"]).select(*columns))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        "component_id")
