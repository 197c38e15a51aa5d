"""Filter interaction audit with a counting-Bloom duplicate prepass.

Five filters judge every document: A few words, B few different words, C many capitals,
D code-like marks, E a text that a smaller id already has.  What an order of filters
removes at each step follows from how many documents fail each set of filters, so the
audit is a table of additive counts per part and failure mask; the 120 orders are read
from it.

Only E needs other documents.  A counting Bloom filter finds the texts that cannot
repeat: a text's hash names a block of 64 counters (as many blocks as documents) and
one counter in each quarter of the block.  Tasks count their own rows, the counts are
merged by a grouped sum, and a text one of whose counters is 1 is unique for certain.
Blocks that could hold a repeat at all, those with a counter over 1 in every quarter,
are few; after a check of their number they are broadcast to the scan of the texts, and
only texts of possible repeats are shuffled, for the exact smallest id of each whole
text.  (With more such blocks than ``broadcast_if_small`` allows the texts meet them in
a shuffle join instead, with the same result.)

A null text, source or label counts as empty text, empty part, no label.  Each row is a
document; rows that repeat an id and its text are both counted and neither is E by the
other.  A null id is larger than all others and not smaller than another null.  Several
labels of one id count together (any quality 1, any toxic 1).  An empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import broadcast_if_small
from .common import read_table, same, written

#: Fixed by the contract: filters in the order of their bits.
FILTERS = "ABCDE"
MIN_WORDS = 50
DISTINCT_PER_100 = 65
CAPITALS_PER_100 = 5
MARKS = re.compile(rb"[#$%&*|]")
CAPITALS = bytes(range(65, 91))
#: Suspect blocks that are broadcast at most.
SUSPECTS = 1 << 20
#: Bytes of a text that are cut into words at a time.
PIECE = 1 << 22
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def words_of(data: bytes) -> tuple[int, int]:
    """Words and different words, a piece of the text at a time."""
    n, seen, at = 0, set(), 0
    while at < len(data):
        found = _SPACE.search(data, at + PIECE) if len(data) - at > 2 * PIECE else None
        cut = found.start() if found else len(data)
        words = data[at:cut].split()
        n += len(words)
        seen.update(words)
        at = cut
    return n, len(seen)


def failures(data: bytes, n_chars: int) -> int:
    """Bits of the filters A to D that a text fails."""
    n, distinct = words_of(data)
    capitals = len(data) - len(data.translate(None, CAPITALS))
    return ((n < MIN_WORDS) | (100 * distinct < DISTINCT_PER_100 * n) << 1
            | (100 * capitals > CAPITALS_PER_100 * n_chars) << 2 | bool(MARKS.search(data)) << 3)


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column(3)
        masks = [failures(t.as_buffer().to_pybytes(), n)
                 for t, n in zip(text, pc.utf8_length(text).to_pylist())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(masks, pa.int32())],
                                         ["id", "part", "h", "mask"])


def _counters(h: Column, blocks: int) -> tuple[Column, Column]:
    """A hash's block, and the bits of its four counters, one in each quarter of it."""
    places = F.xxhash64(h)
    bits = F.lit(0).cast("long")
    for q in range(4):
        place = F.shiftrightunsigned(places, 4 * q).bitwiseAND(F.lit(15)).cast("int") + F.lit(16 * q)
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return F.pmod(h, F.lit(blocks)), bits


def _quarters(bits: str) -> list[Column]:
    return [F.col(bits).bitwiseAND(F.lit(x)) for x in (0xFFFF, 0xFFFF << 16, 0xFFFF << 32, -1 << 48)]


def possible_repeats(hashes: DataFrame, n: int) -> DataFrame:
    """``hashes(h)`` of ``n`` texts → ``(block, twice)``: the blocks with a counter over 1
    in every quarter, and the bits of those counters."""
    block, bits = _counters(F.col("h"), max(1, n))
    cells = hashes.select(block.alias("block"), bits.alias("bits"))
    cells = cells.select("block", F.explode(F.array(*_quarters("bits"))).alias("counter"))
    over = cells.groupBy("block", "counter").agg(F.count("*").alias("n")).where("n > 1")
    blocks = over.groupBy("block").agg(F.bit_or("counter").alias("twice"))
    return blocks.where(F.least(*[(x != 0).cast("int") for x in _quarters("twice")]) == 1)


def repeats(docs: DataFrame, facts: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(id, h)`` of the rows whose text a smaller id has."""
    n = facts.count()
    suspects = written(possible_repeats(facts, n), "suspects")
    keyed = docs.select(F.col(doc_id).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    block, bits = _counters(F.col("h"), max(1, n))
    keyed = keyed.withColumn("h", F.xxhash64("text")).withColumn("block", block).withColumn("bits", bits)
    texts = written(
        keyed.join(broadcast_if_small(suspects, SUSPECTS), "block")
        .where(F.col("bits").bitwiseAND(F.col("twice")) == F.col("bits")).select("id", "h", "text"), "suspect-texts")
    firsts = written(texts.groupBy("text").agg(F.min("id").alias("first"), F.count("*").alias("n"))
                     .where("n > 1").select("text", "first"), "first-ids")
    later = F.col("id").isNull() & F.col("first").isNotNull() | (F.col("id") > F.col("first"))
    return texts.join(firsts, "text").where(later).select("id", "h").distinct()


def failure_counts(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   source: str = "source") -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents of each part that fail just the
    filters of ``mask``, and those of them that are labelled good or toxic."""
    whole = docs.select(F.col(doc_id).alias("id"), F.coalesce(source, F.lit("")).alias("part"),
                        F.coalesce(text, F.lit("")).alias("text"))
    id_type = whole.schema["id"].dataType.simpleString()
    facts = written(whole.select("id", "part", F.xxhash64("text").alias("h"), "text")
                    .mapInArrow(_judged, f"id {id_type}, part string, h long, mask int"), "facts")
    again = repeats(docs, facts, doc_id, text).select(F.col("id").alias("_id"), F.col("h").alias("_h"))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_doc")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    found = (facts.join(again, same(F.col("id"), F.col("_id")) & (F.col("h") == F.col("_h")), "left")
             .join(known, F.col("id") == F.col("_doc"), "left"))
    mask = F.col("mask") + F.when(F.col("_h").isNotNull(), 16).otherwise(0)
    return found.groupBy("part", mask.alias("mask")).agg(
        F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))


def order_steps() -> list[tuple[str, int, int, int]]:
    """``(order, step, its filter's bit, bits of the filters before it)`` of all orders."""
    out = []
    for order in itertools.permutations(FILTERS):
        bits = [1 << FILTERS.index(f) for f in order]
        out += [("".join(order), k + 1, bit, sum(bits[:k])) for k, bit in enumerate(bits)]
    return out


def order_effects(counts: DataFrame) -> DataFrame:
    """``failure_counts`` → what each step of each order of the filters does.

    The counts have at most 32 rows per part; each is spread over the 600 steps."""
    steps = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(k).alias("step"), F.lit(bit).alias("bit"),
                               F.lit(before).alias("before")) for o, k, bit, before in order_steps()])
    rows = counts.select("*", F.explode(steps).alias("s")).select("part", "mask", "n", "good", "toxic", "s.*")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0
    here = fails & ~gone

    def total(condition, value="n"):
        return F.sum(F.when(condition, F.col(value)).otherwise(F.lit(0))).cast("long")

    # a document that fails j filters is removed by each of them in 120 / j orders
    share = F.col("n") * F.expr("120 div greatest(bit_count(mask), 1)")
    return rows.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"), total(here).alias("removed"), total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"), total(here, "good").alias("good_lost"),
        total(here, "toxic").alias("toxic_lost"),
        F.sum(F.when(fails, share).otherwise(F.lit(0))).cast("long").alias("shapley"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return order_effects(failure_counts(docs, read_table(spark, sf_dir, "labels")))


OP13_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
     m AS (SELECT doc_id, part,
                  (len(w) < {MIN_WORDS})::INT
                  + 2 * (100 * len(list_distinct(w)) < {DISTINCT_PER_100} * len(w))::INT
                  + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {CAPITALS_PER_100} * length(t))::INT
                  + 8 * regexp_matches(t, '[#$%&*|]')::INT
                  + 16 * (doc_id > min(doc_id) OVER (PARTITION BY t))::INT AS mask FROM d),
     l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
     c AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
           FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask),
     f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) f(f, bit)),
     o AS (SELECT concat(a.f, b.f, c.f, d.f, e.f) AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
           FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
           AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
     s AS (SELECT filter_order, i AS step, bits[i] AS bit, coalesce(list_sum(bits[:i - 1]), 0)::INT AS before
           FROM o, range(1, 6) r(i))
SELECT part, filter_order, step::INT AS step,
       sum(CASE WHEN mask & (bit | before) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
       sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
       sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
       sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
       sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
       sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost,
       sum(CASE WHEN mask & bit <> 0 THEN n * (120 // bit_count(mask)) ELSE 0 END)::BIGINT AS shapley
FROM c, s GROUP BY part, filter_order, step
"""
