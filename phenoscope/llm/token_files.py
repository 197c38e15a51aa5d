"""Token ids as ORC files: one row per document, in ascending order of id.

The table is cut into ranges of document ids, each is sorted, encoded in that order and
written as one file, so files follow each other by id, and rows inside them.  ORC
stores the ids with integer run-length encoding, keeps a row index (smallest and largest
id of each ``ROW_INDEX`` rows) and a Bloom filter on ``doc_id``.  A reader that asks
for some documents skips files, stripes and row groups from that metadata alone; a
reader of everything gets whole stripes as independent tasks.

A row also holds its ``part`` (the range) and ``place`` (ids before it in the part): the
running sum is known while a part is written in order, so the place among all ids needs one
sum per part, not a sort of the documents.

Encoding goes by pieces of text: a piece ends before white space that follows something
else, and between a Latin letter and another ASCII character.  The byte-level pattern never
joins text across such a place, so the ids of a text are those of its pieces.  Many texts are
cut at once, by the kinds of neighbouring bytes; Arrow looks their
pieces up among those remembered and puts the ids together.  Each different piece is encoded once
per worker as long as its bounded memory holds it; unknown words of a blank and letters are encoded
many together.  Text with other than the six ASCII blanks is encoded as a
whole, where a letter, digit or comma before a blank cuts a very long one.

A null text is empty and gives the end id alone.  Rows that repeat an id are documents
of their own, ordered by text hash, then by their place in the input; null ids come
first.  An empty table gives no file and an empty result; further columns are ignored.
Strings of special tokens inside a text are ordinary text.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from ..session import broadcast_if_small, scratch_path
from .common import read_table, strings, text_slices

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: The id behind each document.
END = 0
#: Rows of a row index entry, bytes of a stripe, false positives of a Bloom filter.
ROW_INDEX = 1_000
STRIPE = 16 << 20
FALSE_POSITIVES = 0.01
#: Bytes that a worker's remembered pieces and their ids may take before the next texts.
REMEMBERED = 12 << 20
#: Characters of a text that are encoded at a time.
SEGMENT = 1 << 20
#: Characters of the texts that are cut at a time.
SLICE = 4 << 20
#: Unknown words that are encoded together.
TOGETHER = 1_000

_LETTER = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
#: Kinds of bytes; those of non-ASCII characters and the ASCII separators may be white space.
_SIGN, _LETTERS, _BLANKS, _ODD = range(4)
_KINDS = bytes(_BLANKS if chr(i) in " \t\n\v\f\r" else _ODD if i > 0x7f or 0x1c <= i <= 0x1f
               else _LETTERS if chr(i).isalpha() else _SIGN for i in range(256))
#: First byte of the letters from \xc0 to \xff, second byte of the two signs among them.
_LATIN, _LATIN_SIGNS = 0xc3, (0x97, 0xb7)
#: White space, and what some libraries take for it, beside the six ASCII blanks.
_OTHER = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")
_CUT = re.compile("[A-Za-z0-9,][ \n]")
#: Pieces that are one word of the pattern wherever they stand, and the byte-level form of a blank.
_WORD = re.compile(f" [{_LETTER}]+")
_BLANK = "\u0120"
_BYTES = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
_LATIN_LETTERS = re.compile("[\xc0-\xff]")
_LATIN_FORMS = {c: _BYTES.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xc0, 0x100))}


def segments(text: str, limit: int = SEGMENT) -> Iterator[str]:
    """A text in parts that can be encoded on their own."""
    start = 0
    while len(text) - start > 2 * limit:
        found = _CUT.search(text, start + limit)
        if not found:
            break
        yield text[start:found.start() + 1]
        start = found.start() + 1
    if start < len(text):
        yield text[start:]


def pieces(texts: list[str]) -> tuple[pa.StringArray, np.ndarray]:
    """The pieces of texts, one text's after the other's, and their number before each text
    and in all."""
    data = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, data)])
    joined = b"".join([*data, b"\0"])
    kind = np.frombuffer(joined.translate(_KINDS), np.uint8)
    if not joined.isascii():
        raw, kind = np.frombuffer(joined, np.uint8), kind.copy()
        at = np.flatnonzero(raw == _LATIN)
        at = at[~np.isin(raw[at + 1], _LATIN_SIGNS)]
        kind[at] = kind[at + 1] = _LETTERS
    left, right = kind[:-2], kind[1:-1]
    cut = np.zeros(len(joined), bool)
    cut[1:-1] = (right == _BLANKS) & (left != _BLANKS) | (left == _LETTERS) & (right == _SIGN)
    for i in np.flatnonzero(np.maximum.reduceat(kind, bounds[:-1]) == _ODD):
        if _OTHER.search(texts[i]):
            cut[bounds[i]:bounds[i + 1]] = False
    cut[bounds] = True
    at = np.flatnonzero(cut)
    found = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(joined))
    return found, np.searchsorted(at, bounds)


def word_tokenizer(tokenizer: str) -> Tokenizer | None:
    """The same model for words of a blank and letters in byte-level form: the blank alone cuts
    them, and without a cache, as none comes twice.  None if the pattern is another one."""
    spec = json.loads(tokenizer)
    cut, model = spec.get("pre_tokenizer") or {}, spec["model"]
    if (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex", True)) != ("ByteLevel", False, True) or spec.get("normalizer"):
        return None
    merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    options = {k: v for k, v in model.items() if v is not None and k not in ("type", "vocab", "merges")}
    words = Tokenizer(models.BPE(model["vocab"], merges, cache_capacity=0, **options))
    words.pre_tokenizer = pre_tokenizers.Split(_BLANK, "merged_with_next")
    return words


class Encoder:
    """Texts → little-endian 32-bit ids, with a bounded memory of pieces.

    Of a full memory the pieces used again since it was last full are kept; if they take more
    than half of it, the earlier half of them."""

    def __init__(self, tokenizer: Tokenizer, words: Tokenizer | None = None):
        """``words``: ``word_tokenizer`` of the same file."""
        tokenizer.encode_special_tokens = True
        self.tokenizer, self.words = tokenizer, words
        vocab = tokenizer.get_vocab()
        self.opens = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.opens[[i for token, i in vocab.items() if token.startswith(_BLANK)]] = True
        self.known, self.ids = pa.array([], pa.string()), pa.array([], pa.list_(pa.int32()))
        self.used = np.zeros(0, bool)

    def _one_by_one(self, pieces: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False) if pieces else ()
        return [array("I", e.ids).tobytes() for e in found]

    def _words(self, words: list[str]) -> list[bytes]:
        """Pieces of a blank and letters, encoded as one text: only the first token of each
        starts with the blank."""
        text = "".join(words)
        if self.words:
            if not text.isascii():
                text = _LATIN_LETTERS.sub(lambda m: _LATIN_FORMS[m[0]], text)
            text = text.replace(" ", _BLANK)
        ids = np.array((self.words or self.tokenizer).encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        starts = np.flatnonzero(self.opens[ids])
        if len(starts) != len(words) or starts[0]:
            return self._one_by_one(words)
        data, cut = ids.tobytes(), [*(4 * starts).tolist(), 4 * len(ids)]
        return [data[a:b] for a, b in zip(cut, cut[1:])]

    def _encoded(self, distinct: list[str]) -> pa.ListArray:
        found = [b""] * len(distinct)
        words, other = [], []
        for i, p in enumerate(distinct):
            (words if _WORD.fullmatch(p) else other).append(i)
        for encode, new in (self._words, words), (self._one_by_one, other):
            for a in range(0, len(new), TOGETHER):
                at = new[a:a + TOGETHER]
                for i, ids in zip(at, encode([distinct[i] for i in at])):
                    found[i] = ids
        ends = np.cumsum([0, *map(len, found)]) // 4
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<i4")))

    def _size(self) -> int:
        return self.known.nbytes + self.ids.nbytes

    def _keep(self, at: np.ndarray) -> None:
        self.known, self.ids = self.known.take(pa.array(at)), self.ids.take(pa.array(at))

    def _parts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self._size() > REMEMBERED:
            at = np.flatnonzero(self.used)
            self._keep(at)
            if self._size() > REMEMBERED // 2:
                self._keep(np.arange(len(at) // 2))
            self.used = np.zeros(len(self.known), bool)
        found, bounds = pieces(texts)
        at = pc.fill_null(pc.index_in(found, self.known), -1).to_numpy()
        unknown = at < 0
        self.used[at[~unknown]] = True
        if unknown.any():
            new = found.filter(pa.array(unknown)).dictionary_encode()
            at = at.copy()
            at[unknown] = len(self.known) + new.indices.to_numpy()
            self.ids = pa.concat_arrays([self.ids, self._encoded(new.dictionary.to_numpy(zero_copy_only=False).tolist())])
            self.known = pa.concat_arrays([self.known, new.dictionary])
            self.used = np.concatenate([self.used, np.zeros(len(new.dictionary), bool)])
        taken = self.ids.take(pa.array(at))
        return taken.flatten().to_numpy(), np.diff(taken.offsets.to_numpy()[bounds])

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts, one text's after the other's, and how many each has."""
        parts = [(i, s) for i, t in enumerate(texts) for s in segments(t)]
        ids, n = [np.zeros(0, "<i4")], np.zeros(len(texts), np.int64)
        for a, b in text_slices([len(s) for _, s in parts], SLICE):
            values, counts = self._parts([s for _, s in parts[a:b]])
            ids.append(values)
            np.add.at(n, [i for i, _ in parts[a:b]], counts)
        return np.concatenate(ids), n

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0].tobytes()


@functools.lru_cache(maxsize=1)
def _encoder(tokenizer: str) -> Encoder:
    """The encoder of a Python worker, which the tasks that it runs share."""
    # Spark runs a task per core; threads of the library would only get in their way
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(Tokenizer.from_str(tokenizer), word_tokenizer(tokenizer))


def _encoded(carried):
    """Sorted documents → the rows of a part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(carried.value)
        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = strings(batch, "text")
            for a, b in text_slices([len(t) for t in texts], SLICE):
                ids, n = encoder.encode_all(texts[a:b])
                values = pa.array(np.insert(ids, np.cumsum(n), END))
                n += 1
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.full(b - a, part, np.int32)),
                     pa.array(place + ends - n), pa.array(n),
                     pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), values)],
                    ["doc_id", "part", "place", "n", "ids"])
                place += int(ends[-1])

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, doc_id: str = "doc_id",
                      text: str = "text") -> str:
    """Encode ``docs`` into ORC files under ``path``; the schema of their rows is returned.

    As many ranges as the session has shuffle partitions; equal ids are kept apart by text
    and place, so a hot id falls into several ranges."""
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        carried = spark.sparkContext.broadcast(f.read())
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    keyed = keyed.withColumn("h", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    schema = f"doc_id {keyed.schema['doc_id'].dataType.simpleString()}, part int, place long, n long, ids array<int>"
    (keyed.repartitionByRange("doc_id", "h", "row").sortWithinPartitions("doc_id", "h", "row")
     .select("doc_id", "text").mapInArrow(_encoded(carried), schema)
     .write.option("orc.compress", "zstd").option("orc.stripe.size", STRIPE)
     .option("orc.row.index.stride", ROW_INDEX).option("orc.rows.between.memory.checks", 256)
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", FALSE_POSITIVES).orc(path))
    return schema


def read_token_files(spark: SparkSession, path: str, schema: str, doc_ids: list | None = None) -> DataFrame:
    """The rows of the files, or of some documents: their ids are looked up in the
    metadata, and only row groups that may hold one are read."""
    rows = spark.read.schema(schema).orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(doc_ids))


def with_starts(rows: DataFrame) -> DataFrame:
    """``rows`` with ``start``: the ids of all documents before each.

    The totals (one row per part) come from the columns ``place`` and ``n`` alone."""
    totals = rows.groupBy("part").agg(F.max(F.col("place") + F.col("n")).alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("_before"))
    return rows.join(broadcast_if_small(offsets), "part").withColumn("start", F.col("_before") + F.col("place"))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(2)
        ends = ids.offsets.to_numpy()
        values = np.ascontiguousarray(ids.values.to_numpy(), "<i4").view(np.uint8)
        crc = [zlib.crc32(values[4 * a:4 * b]) for a, b in zip(ends, ends[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())],
            ["doc_id", "start", "n_tokens", "ids_crc32"])


def token_digests(rows: DataFrame) -> DataFrame:
    """Per document of the files: where its ids start, how many there are, their CRC-32."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    return with_starts(rows).select("doc_id", "start", "ids").mapInArrow(
        _measured, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    schema = write_token_files(read_table(spark, sf_dir, "documents"), path)
    return token_digests(read_token_files(spark, path, schema))
