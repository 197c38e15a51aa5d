"""Benchmark decontamination: size-partitioned MinHash containment search.

A document contains a test item when it has at least ``THRESHOLD`` of the item's
distinct five-word shingles, wherever they stand.  A long document shares next to
nothing of its own set with a short item, so both sets' sketches could not be compared; the
search is asymmetric.  Items are partitioned by the size of their shingle set
(powers of two).  Each partition has one MinHash length: the k smallest hashes
of an item, with k one more than the shingles that a match in the partition may
miss.  So a document that contains an item has one of its k sketch shingles at least: no
match is lost.  Documents probe with all of their shingles; where enough of a
sketch is met, the exact containment of whole shingles decides.

Words are runs of digits, letters and other characters beyond ASCII, lower-cased.
The items are a stated query set: they go against all documents in blocks of
bounded size, each a pass over the documents; no block is cut by rows of documents.

Null or empty texts, and items of fewer than five words, have no shingle and match
nothing.  Each row of the items and of the documents counts by itself, repeated
rows included; empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, strings

WIDTH = 5
THRESHOLD = 0.8
#: Items of a block, and bytes of their texts; a longer item is a block of its own.
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 32 << 20
#: Characters of a text that are cut into words at a time.
PIECE = 1 << 22

_IS_WORD = re.compile(rb"[0-9a-z\x80-\xff]")
_TO_SPACE = bytes(c if _IS_WORD.match(bytes([c])) else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_TO_SPACE).split()


def _word_lists(text: str, width: int) -> Iterator[list[bytes]]:
    """The words, of a long text in lists that overlap by width - 1 words."""
    at, carry = 0, []
    while at < len(text):
        cut = len(text)
        if len(text) - at > 2 * PIECE:
            cut = next((i for i in range(at + PIECE, len(text)) if text[i].isspace()), cut)
        words = carry + words_of(text[at:cut])
        yield words
        carry, at = words[len(words) - width + 1:] if len(words) >= width else words, cut


class ItemIndex:
    """Shingles and size-partitioned sketches of one block of items."""

    def __init__(self, items: list[tuple], width: int = WIDTH, threshold: float = THRESHOLD):
        self.width, self.ids, self.sizes, self.need = width, [], [], []
        self.vocabulary: dict[bytes, int] = {}
        shingle_at: dict[tuple, int] = {}
        pairs, sketch_pairs = [], []
        for item_id, text in items:
            words = words_of(text or "")
            shingles = {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}
            if not shingles:
                continue
            me, size = len(self.ids), len(shingles)
            largest = 1 << (size - 1).bit_length()  # of the size partition
            may_miss = largest - int(np.ceil(threshold * largest - 1e-9))
            lost = size - int(np.ceil(threshold * size - 1e-9))
            length = min(size, may_miss + 1)
            for w in words:
                self.vocabulary.setdefault(w, len(self.vocabulary))
            ordered = sorted(shingles, key=lambda s: (xxhash.xxh64_intdigest(b" ".join(s)), s))
            for rank, s in enumerate(ordered):
                at = shingle_at.setdefault(s, len(shingle_at))
                pairs.append((at, me))
                if rank < length:
                    sketch_pairs.append((at, me))
            self.ids.append(item_id)
            self.sizes.append(size)
            self.need.append(max(1, length - lost))
        self.least = [int(np.ceil(threshold * n - 1e-9)) for n in self.sizes]
        known = np.array([[self.vocabulary[w] for w in s] for s in shingle_at],
                         np.int64).reshape(len(shingle_at), width)
        codes = self._codes(known)
        order = np.argsort(codes, kind="stable")
        self.codes, self.shingles = codes[order], known[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.owners = self._by_shingle(pairs, place)
        self.sketch_owners = self._by_shingle(sketch_pairs, place)
        self.in_sketch = np.zeros(len(order), bool)
        self.in_sketch[list(self.sketch_owners)] = True

    @staticmethod
    def _by_shingle(pairs, place) -> dict[int, list[int]]:
        owners: dict[int, list[int]] = {}
        for at, me in pairs:
            owners.setdefault(int(place[at]), []).append(me)
        return owners

    @staticmethod
    def _codes(ids: np.ndarray) -> np.ndarray:
        code = np.zeros(len(ids), np.uint64)
        for j in range(ids.shape[1]):
            code = code * np.uint64(0x9E3779B97F4A7C15) + ids[:, j].astype(np.uint64) + np.uint64(1)
        return code

    def _found(self, text: str) -> np.ndarray:
        """Which of the block's shingles the text has."""
        found = np.zeros(len(self.codes), bool)
        get, w = self.vocabulary.get, self.width
        for words in _word_lists(text, w):
            if len(words) < w:
                continue
            ids = np.fromiter(map(get, words, itertools.repeat(-1)), np.int64, len(words))
            known = np.concatenate(([0], np.cumsum(ids >= 0)))
            at = np.flatnonzero(known[w:] - known[:-w] == w)
            if not len(at):
                continue
            own = ids[at[:, None] + np.arange(w)]
            code = self._codes(own)
            first = np.searchsorted(self.codes, code)
            last = np.searchsorted(self.codes, code, side="right")
            for k in range(int((last - first).max(initial=0))):  # one turn unless codes collide
                may = np.flatnonzero(first + k < last)
                place = first[may] + k
                found[place[(self.shingles[place] == own[may]).all(axis=1)]] = True
        return found

    def matches(self, text: str | None) -> list[tuple]:
        """``(item_id, shared, size)`` of the items that the text contains."""
        if not text or not len(self.codes):
            return []
        found = self._found(text)
        met: dict[int, int] = {}
        for place in np.flatnonzero(found & self.in_sketch).tolist():
            for me in self.sketch_owners[place]:
                met[me] = met.get(me, 0) + 1
        candidates = {me for me, n in met.items() if n >= self.need[me]}
        if not candidates:
            return []
        shared = dict.fromkeys(candidates, 0)
        for place in np.flatnonzero(found).tolist():
            for me in self.owners[place]:
                if me in candidates:
                    shared[me] += 1
        return [(self.ids[me], n, self.sizes[me]) for me, n in sorted(shared.items())
                if n >= self.least[me]]


def item_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple]]:
    """The query set, block by block; the driver holds one at a time."""
    block, size = [], 0
    for row in items.select(F.col(item_id), F.col(text)).toLocalIterator():
        block.append((row[0], row[1]))
        size += len(row[1] or "")
        if len(block) >= BLOCK_ITEMS or size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text", width: int = WIDTH,
                 threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, item_id, shared, n_shingles, containment)`` of every document row
    and item row with at least ``threshold`` of the item's shingles in the document."""
    schema = (docs.select(F.col(doc_id).alias("doc_id")).schema
              .add(items.select(F.col(item_id).alias("item_id")).schema.fields[0])
              .add("shared", "long").add("n_shingles", "long").add("containment", "double"))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    out = docs.sparkSession.createDataFrame([], schema)
    for block in item_blocks(items, item_id, item_text):
        index = ItemIndex(block, width, threshold)

        def search(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(i, *m) for i, t in enumerate(strings(batch, "text"))
                        for m in index.matches(t)]
                if rows:
                    at, item, shared, size = map(list, zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(at)), pa.array(item),
                         pa.array(shared, pa.int64()), pa.array(size, pa.int64()),
                         pa.array(np.array(shared) / np.array(size))], schema.names)

        out = out.unionByName(texts.mapInArrow(search, schema))
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text",
                      item_id: str = "item_id", item_text: str = "text", width: int = WIDTH,
                      threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that contain an item; each block of items filters
    what the last one left, without a shuffle."""
    for block in item_blocks(items, item_id, item_text):
        index = ItemIndex(block, width, threshold)

        def clean(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not index.matches(t) for t in strings(batch, text)],
                                            pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_SHINGLES = """
    SELECT DISTINCT {id}, array_to_string(list_slice(w, i, i + 4), ' ') AS s
    FROM (SELECT {id}, w, unnest(range(1, len(w) - 3)) AS i
          FROM (SELECT {id}, regexp_extract_all(lower(text), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w
                FROM {table}))"""

OP3_SQL = f"""
WITH d AS ({_SHINGLES.format(id='doc_id', table='documents')}),
     b AS ({_SHINGLES.format(id='item_id', table='benchmark')}),
     n AS (SELECT item_id, count(*) AS n_shingles FROM b GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS shared, n_shingles,
       count(*)::DOUBLE / n_shingles AS containment
FROM d JOIN b USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_shingles
HAVING count(*) >= ceil({THRESHOLD} * n_shingles - 1e-9)
"""
