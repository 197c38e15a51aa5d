"""Language identification with spans.

The script ranges found in a document narrow its candidate languages; every word
gets a score per candidate (log likelihood of its letter trigrams); a Viterbi
pass with a switching penalty labels the words, so a mixed text is cut into
spans of one language each.

Nulls, empty texts and texts without a letter get ``und``, score 0 and no span.
Repeated rows are labelled alike, an empty table gives an empty result, and an
input column that has the name of a result column is replaced.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_CHARS, read_table, strings, text_slices, without

# fixed values: first and last code point of the main blocks of each script
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F)),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF)),
    "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),),
    "tamil": ((0xB80, 0xBFF),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF),),
    "hangul": ((0x1100, 0x11FF), (0xAC00, 0xD7AF)),
    "kana": ((0x3040, 0x30FF),),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)),
}
OTHER = len(SCRIPTS) + 1
UND = "und"

#: Trigram buckets of the model.
BUCKETS = 1 << 16
#: What changing the language between two words costs, in nats.
SWITCH = 15.0
#: A language uses the scripts that hold at least this share of its letters.
SCRIPT_SHARE = 0.01
_BLOCK = 32


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Script (0: not a letter) and lower-case form of every code point."""
    script = np.zeros(0x110000, np.uint8)
    lower = np.arange(0x110000, dtype=np.uint32)
    for cp in range(0x110000):
        if 0xD800 <= cp < 0xE000 or 0xE0200 <= cp:
            continue
        c = chr(cp)
        if unicodedata.category(c)[0] in "LM":
            script[cp] = OTHER
            low = c.lower()
            if len(low) == 1:
                lower[cp] = ord(low)
    for k, ranges in enumerate(SCRIPTS.values(), 1):
        for a, b in ranges:
            part = script[a:b + 1]
            part[part > 0] = k
    return script, lower


def _words(texts: list[str], shift: int):
    """Of the joined texts: the letters' trigram buckets and scripts, where words
    begin among the letters, each word's text, and its first and last position."""
    script, lower = _tables()
    joined = "\n".join(texts)
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = script[cp]
    is_letter = np.concatenate(([False], kind > 0, [False]))
    at = np.flatnonzero(is_letter[1:-1])
    padded = np.zeros(len(cp) + 2, np.uint32)
    padded[at + 1] = lower[cp[at]]
    mixed = (padded[at] * np.uint32(0x9E3779B1)) ^ (padded[at + 1] * np.uint32(0x85EBCA6B))
    mixed = (mixed ^ (mixed >> np.uint32(15))) + padded[at + 2] * np.uint32(0xC2B2AE35)
    mixed = (mixed ^ (mixed >> np.uint32(13))) * np.uint32(0x27D4EB2F)
    buckets = mixed >> np.uint32(shift)
    begins = np.flatnonzero(~is_letter[at])  # the place before is no letter
    ends = np.append(begins[1:], len(at))
    if not len(at):
        return buckets, kind[at], begins, begins, begins, begins
    first, last = at[begins], at[ends - 1] + 1
    sizes = np.array([len(t) + 1 for t in texts])
    text_ends = np.cumsum(sizes)
    owner = np.searchsorted(text_ends, first, side="right")
    text_start = (text_ends - sizes)[owner]
    return buckets, kind[at], begins, owner, first - text_start, last - text_start


def _pieces(text: str) -> Iterator[tuple[int, str]]:
    """A long text in pieces cut between words where there is such a place."""
    at = 0
    while len(text) - at > 2 * SLICE_CHARS:
        cut = at + SLICE_CHARS
        for near in range(cut, cut + 1000):
            if text[near].isspace():
                cut = near
                break
        yield at, text[at:cut]
        at = cut
    yield at, text[at:]


def _viterbi(scores: np.ndarray, counts: np.ndarray, switch: float) -> np.ndarray:
    """Best label of each word.  ``counts``: words of each document, in order.

    The words of a document are cut into blocks.  All blocks advance together,
    each for every language it may start from, then a scan over the blocks of
    each document joins them: the exact best path without a step per word.
    """
    n, k = scores.shape
    per = -(-counts // _BLOCK)
    first_word, first_block = np.cumsum(counts) - counts, np.cumsum(per) - per
    total = int(per.sum())
    block_doc = np.repeat(np.arange(len(counts)), per)
    in_doc = np.arange(total) - first_block[block_doc]
    word = (first_word[block_doc] + in_doc * _BLOCK)[:, None] + np.arange(_BLOCK)
    real = word < (first_word + counts)[block_doc][:, None]
    s = np.where(real[:, :, None], scores[np.where(real, word, 0)], np.float32(0))

    best = np.where(np.eye(k, dtype=bool), 0, -switch).astype(np.float32) + s[:, 0, None, :]
    changed, source = [], []
    for t in range(1, _BLOCK):
        top = best.max(axis=2)
        source.append(best.argmax(axis=2).astype(np.int16))
        jump = (top - np.float32(switch))[:, :, None]
        changed.append(jump > best)
        best = np.maximum(best, jump) + s[:, t, None, :]

    order = np.argsort(-per, kind="stable")
    steps = int(per.max())
    alive = np.searchsorted(-per[order], -np.arange(1, steps + 1), side="right")
    value, back = np.zeros((len(counts), k), np.float32), []
    for j in range(steps):
        docs = order[:alive[j]]
        reach = value[docs][:, :, None] + best[first_block[docs] + j]
        back.append(reach.argmax(axis=1).astype(np.int16))
        now = reach.max(axis=1)
        value[docs] = now - now.max(axis=1, keepdims=True)
    start, end = np.zeros(total, np.int16), np.zeros(total, np.int16)
    at = value.argmax(axis=1).astype(np.int16)
    for j in range(steps - 1, -1, -1):
        docs = order[:alive[j]]
        blocks = first_block[docs] + j
        end[blocks] = at[docs]
        at[docs] = back[j][np.arange(len(docs)), at[docs]]
        start[blocks] = at[docs]

    label, rows = np.zeros((total, _BLOCK), np.int16), np.arange(total)
    for t in range(_BLOCK - 1, 0, -1):
        label[:, t] = end
        end = np.where(changed[t - 1][rows, start, end], source[t - 1][rows, start], end)
    label[:, 0] = end
    return label[real]


@dataclass
class LanguageModel:
    """``langs`` in order, the log likelihood of every trigram bucket for each of
    them, and which scripts each of them uses (a row of flags per language)."""

    langs: list[str]
    weights: np.ndarray
    uses: np.ndarray
    switch: float = SWITCH

    def label(self, texts: list) -> list[tuple[str, float, list]]:
        """Language, score and spans ``(lang, start, end)`` of each text."""
        out: list = [(UND, 0.0, [])] * len(texts)
        if not self.langs:
            return out
        shift = 32 - (len(self.weights).bit_length() - 1)
        rows, owners, firsts, lasts, scripts = [], [], [], [], []
        # marks without a letter make no word
        parts = [(i, at, p) for i, t in enumerate(texts) if t and any(map(str.isalpha, t))
                 for at, p in _pieces(t)]
        for a, b in text_slices([len(p) for _, _, p in parts]):
            own = np.array([i for i, _, _ in parts[a:b]])
            base = np.array([at for _, at, _ in parts[a:b]])
            buckets, kind, begins, owner, first, last = _words([p for _, _, p in parts[a:b]], shift)
            if not len(begins):
                continue
            rows.append(np.add.reduceat(self.weights[buckets], begins, axis=0))
            scripts.append(kind[begins])
            owners.append(own[owner])
            firsts.append(first + base[owner])
            lasts.append(last + base[owner])
        if not rows:
            return out
        score, owner = np.concatenate(rows), np.concatenate(owners)
        first, last, script = map(np.concatenate, (firsts, lasts, scripts))
        letters = last - first
        fits = self.uses[:, script].T
        narrowed = fits.any(axis=1, keepdims=True)
        score[narrowed & ~fits] -= np.float32(1e4)
        docs, counts = np.unique(owner, return_counts=True)
        label = _viterbi(score, counts, self.switch)
        k = len(self.langs)
        pos = np.repeat(np.arange(len(docs)), counts)
        share = np.bincount(pos * k + label, letters, len(docs) * k).reshape(-1, k)
        whole = np.add.reduceat(score.astype(np.float64), np.cumsum(counts) - counts, axis=0)
        whole = np.exp(whole - whole.max(axis=1, keepdims=True))
        whole /= whole.sum(axis=1, keepdims=True)
        # most letters wins; of equals, the language that is likelier for the whole text
        best = (share + 0.5 * whole).argmax(axis=1)
        cut = np.flatnonzero(np.concatenate(
            ([True], (label[1:] != label[:-1]) | (pos[1:] != pos[:-1]), [True])))
        spans: list[list] = [[] for _ in docs]
        for x, y in zip(cut[:-1].tolist(), cut[1:].tolist()):
            spans[pos[x]].append({"lang": self.langs[label[x]], "start": int(first[x]),
                                  "end": int(last[y - 1])})
        part = share[np.arange(len(docs)), best] / share.sum(axis=1)
        sure = np.maximum(whole[np.arange(len(docs)), best], 1.0 / k)
        for j, i in enumerate(docs.tolist()):
            sure_j = sure[j] if len(spans[j]) == 1 else 1.0
            out[i] = (self.langs[best[j]], float(part[j] * sure_j), spans[j])
        return out


def fit_language_model(docs: DataFrame, text: str = "text", lang: str = "lang",
                       buckets: int = BUCKETS, switch: float = SWITCH) -> LanguageModel:
    """Trigram model of every non-null ``lang`` over all rows of ``docs``.

    Each task sends its counts once per language and bucket; the driver gets at
    most languages × buckets totals, whatever the input's size.
    """
    shift = 32 - (buckets.bit_length() - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            pairs = sorted(((g, p) for t, g in zip(strings(batch, "text"), strings(batch, "lang"))
                            if t and g is not None for _, p in _pieces(t)), key=lambda x: x[0])
            for a, b in text_slices([len(p) for _, p in pairs]):
                for g in dict.fromkeys(g for g, _ in pairs[a:b]):
                    found, kind, *_ = _words([p for h, p in pairs[a:b] if h == g], shift)
                    total = totals.setdefault(g, np.zeros(buckets + OTHER + 1, np.int64))
                    total[:buckets] += np.bincount(found, minlength=buckets)
                    total[buckets:] += np.bincount(kind, minlength=OTHER + 1)
        for g, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([g] * len(at), pa.string()), pa.array(at, pa.int32()),
                 pa.array(total[at], pa.int64())], ["lang", "slot", "n"])

    counted = (docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
               .where("text is not null and lang is not null")
               .mapInArrow(count, "lang string, slot int, n long")
               .groupBy("lang", "slot").agg(F.sum("n").alias("n"))).toPandas()
    langs = sorted(counted["lang"].unique())
    totals = np.zeros((len(langs), buckets + OTHER + 1))
    totals[np.searchsorted(langs, counted["lang"].to_numpy(str)) if langs else [],
           counted["slot"].to_numpy(int)] = counted["n"]
    grams, scripts = totals[:, :buckets] + 0.1, totals[:, buckets:]
    weights = np.log(grams / grams.sum(axis=1, keepdims=True)).T.astype(np.float32)
    uses = scripts >= SCRIPT_SHARE * np.maximum(1, scripts.sum(axis=1, keepdims=True))
    return LanguageModel(langs, np.ascontiguousarray(weights), uses, switch)


SPAN = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()),
                                 T.StructField("start", T.LongType()),
                                 T.StructField("end", T.LongType())]))


def identify_language(docs: DataFrame, model: LanguageModel, text: str = "text",
                      names: tuple[str, str, str] = ("lang_pred", "score", "lang_spans")) -> DataFrame:
    """``docs`` with the predicted language, its score (share of the letters under it;
    for a text of one span its probability) and the spans, under ``names``."""
    kept = without(docs, *names)
    schema = T.StructType(kept.schema.fields + [
        T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType()),
        T.StructField(names[2], SPAN)])
    span = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = strings(batch, text)
            for a, b in text_slices([len(t or "") for t in texts]):
                found = model.label(texts[a:b])
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([x[0] for x in found], pa.string()),
                     pa.array([x[1] for x in found], pa.float64()),
                     pa.array([x[2] for x in found], span)],
                    [*part.schema.names, *names])

    return kept.mapInArrow(label, schema)


def held_out(doc_id: str | Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; no id: false."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit_language_model(docs.where(~held_out("doc_id")))
    return (identify_language(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score"))
