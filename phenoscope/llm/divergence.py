"""Source divergence audit: where the sources of a language differ in their words.

A language keeps the terms that enough of its documents hold.  The kept terms, sorted
by bytes, become minimal acyclic transducers (``vocabulary.py``) that map a term to its
place among the language's terms; ranges of terms are built in parallel and numbered
through.  All texts are then streamed through the transducers and recounted as ordinals
per source, so everything behind the recount shuffles numbers, not words, and ties
between terms go by ordinal, which is their byte order.

A probability counts in billionths, exactly: ``1 + floor(10^9 (count + 2) / (N + 2 V))``.
Two probabilities differ by ``floor((p - q)^2 / (p + q))``.  Sources are compared in
pairs over all kept terms: a task takes a block of ordinals with the counts of all
sources and sums each pair's differences in it, and blocks are added up.  A block is as
long as keeps sources x terms below ``CELLS``.  A source's own terms are those that it
has more often than its language; a ranking keeps ten rows per task before it shuffles.

The transducers go to all tasks as a broadcast of at most ``GROUP_BYTES``; larger
vocabularies are recounted in groups of ranges, one scan of the texts per group.

Null text, language and source are the empty string.  Each row is a document, also one
that repeats an id.  Groups without any term are listed, with value 0 where a language
keeps no term.  An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small
from .common import read_table, strings, text_slices, written
from .vocabulary import FOLD, Shelf, Transducer, build, pieces, term_places

MIN_DOCS = 10
TOP = 10
#: Terms of a transducer, bytes of transducers that a scan of the texts carries.
SHARD_TERMS = 1 << 18
GROUP_BYTES = 64 << 20
#: Counts that a task gathers before it hands them on.
HELD = 1 << 18
#: Sources x terms that a task compares at once, and terms of a block at most.
CELLS = 1 << 20
BLOCK = 1 << 12
_FOLDED = FOLD.tobytes()


def terms_of(text: bytes) -> set[bytes]:
    """The different terms of a text, a piece at a time."""
    found: set[bytes] = set()
    for _, piece in pieces(np.frombuffer(text, np.uint8)):
        found.update(piece.tobytes().translate(_FOLDED).split())
    return found


def _texts(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    return docs.select(*[F.coalesce(c, F.lit("")).alias(n)
                         for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])


def _doc_counts(most: int):
    """Texts → ``(lang, term, n)`` with the documents that hold a term, handed on whenever
    more than ``most`` terms are held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        size = 0

        def out():
            for lang, counts in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counts), pa.string()),
                     pa.array(list(counts), pa.binary()).cast(pa.string()),
                     pa.array(list(counts.values()), pa.int64())], ["lang", "term", "n"])
            held.clear()

        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            for lang, text in zip(strings(batch, "lang"), texts):
                counts = held.setdefault(lang, Counter())
                size -= len(counts)
                counts.update(terms_of(text.as_buffer()))
                size += len(counts)
                if size > most:
                    yield from out()
                    size = 0
        yield from out()

    return run


def _build(most: int):
    """Sorted ``(lang, term)`` → a transducer for each ``most`` terms of a language."""
    def shard(lang, terms):
        return pa.RecordBatch.from_arrays(
            [pa.array([lang]), pa.array([terms[0]]), pa.array([terms[-1]]), pa.array([len(terms)], pa.int64()),
             pa.array([build(terms).dump()], pa.binary())], ["lang", "first", "last", "n", "fst"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, terms = None, []
        for batch in batches:
            for next_lang, term in zip(strings(batch, "lang"), strings(batch, "term")):
                if terms and (next_lang != lang or len(terms) == most):
                    yield shard(lang, terms)
                    terms = []
                lang = next_lang
                terms.append(term.encode())
        if terms:
            yield shard(lang, terms)

    return run


def vocabularies(texts: DataFrame) -> DataFrame:
    """``texts(lang, text)`` → ``(lang, first, last, n, fst, offset)``: the transducers of
    each language's kept terms; ``offset`` numbers the first term of each."""
    counts = texts.select("lang", "text").mapInArrow(_doc_counts(HELD), "lang string, term string, n long")
    kept = written(counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_DOCS)
                   .select("lang", "term"), "kept-terms")
    parts = max(1, -(-kept.count() // SHARD_TERMS))
    shards = written(kept.repartitionByRange(parts, "lang", "term").sortWithinPartitions("lang", "term")
                     .mapInArrow(_build(SHARD_TERMS), "lang string, first binary, last binary, n long, fst binary"), "transducers")
    # one row per 2^18 terms
    before = Window.partitionBy("lang").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    places = shards.select("lang", "first", "n").withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return shards.join(places.drop("n"), ["lang", "first"])


def _groups(shards: DataFrame) -> Iterator[list]:
    """The transducers in groups of at most ``GROUP_BYTES``, one group at a time."""
    group, size = [], 0
    for r in shards.select("lang", "first", "last", "offset", "fst").toLocalIterator():
        if group and size + len(r.fst) > GROUP_BYTES:
            yield group
            group, size = [], 0
        group.append((r.lang, bytes(r["first"]), bytes(r["last"]), r.offset, bytes(r.fst)))
        size += len(r.fst)
    if group:
        yield group


def _summed(code: np.ndarray, ordinal: np.ndarray, n: np.ndarray):
    """``((code, ordinal), sum of n)`` of the different pairs."""
    order = np.lexsort((ordinal, code))
    code, ordinal, n = code[order], ordinal[order], n[order]
    head = np.flatnonzero(np.concatenate(([True], (code[1:] != code[:-1]) | (ordinal[1:] != ordinal[:-1])))[:len(code)])
    return (code[head], ordinal[head]), np.add.reduceat(n, head) if len(head) else n


def _shelves(rows) -> dict[str, Shelf]:
    by_lang: dict[str, list] = {}
    for lang, first, last, offset, fst in rows:
        by_lang.setdefault(lang, []).append((first, last, offset, Transducer.load(fst)))
    return {lang: Shelf(x) for lang, x in by_lang.items()}


def _recount(carried, most: int):
    """Texts → ``(lang, source, ordinal, n)`` of the terms in the carried transducers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shelves = _shelves(carried.value)
        codes: dict[str, int] = {}
        held: dict[str, list] = {}
        size = 0

        def out():
            names = np.array(list(codes), object)
            for lang, parts in held.items():
                code, ordinal, n = (np.concatenate(x) for x in zip(*parts))
                (code, ordinal), sums = _summed(code, ordinal, n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(sums), pa.string()), pa.array(names[code], pa.string()),
                     pa.array(ordinal), pa.array(sums)], ["lang", "source", "ordinal", "n"])
            held.clear()
            codes.clear()

        for batch in batches:
            langs, sources = strings(batch, "lang"), strings(batch, "source")
            texts = batch.column(batch.schema.get_field_index("text"))
            lengths = pc.binary_length(texts).to_pylist()
            rows: dict[str, list[int]] = {}
            for i, lang in enumerate(langs):
                if lang in shelves:
                    rows.setdefault(lang, []).append(i)
            for lang, own in rows.items():
                for a, b in text_slices([lengths[i] for i in own]):
                    # terms never cross texts: a byte outside of all terms stands between
                    data = np.frombuffer(b"\n".join(texts[i].as_buffer() for i in own[a:b]), np.uint8)
                    ends = np.cumsum([lengths[i] + 1 for i in own[a:b]])
                    code = np.array([codes.setdefault(sources[i], len(codes)) for i in own[a:b]])
                    for start, piece in pieces(data):
                        at, long = term_places(piece)
                        ordinals = shelves[lang].ordinals(FOLD[piece], at, long)
                        known = np.flatnonzero(ordinals >= 0)
                        of = code[np.searchsorted(ends, at[known] + start, "right")]
                        (of, ordinals), n = _summed(of, ordinals[known], np.ones(len(known), np.int64))
                        held.setdefault(lang, []).append((of, ordinals, n))
                        size += len(n)
                if size > most:
                    yield from out()
                    size = 0
        yield from out()

    return run


def _decode(carried):
    """Rows with ``lang`` and ``ordinal`` → those whose ordinal is of the carried
    transducers, with its ``item``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shelves = _shelves(carried.value)
        for batch in batches:
            items = [shelves[lang].term(o) if lang in shelves else None
                     for lang, o in zip(strings(batch, "lang"), strings(batch, "ordinal"))]
            items = pa.array([x and x.decode() for x in items], pa.string())
            found = pa.RecordBatch.from_arrays([*batch.columns, items], [*batch.schema.names, "item"])
            yield found.filter(items.is_valid())

    return run


def _billionths(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (n + 2 v)), exactly."""
    whole = [x.cast("decimal(19,0)") for x in (count + 2, n + 2 * v)]
    return F.call_function("div", whole[0] * F.lit(10**9).cast("decimal(10,0)"), whole[1]) + 1


def _billionths_of(counts: np.ndarray, total: int) -> np.ndarray:
    """The same by long division, three decimal places at a time."""
    rest, out = counts + 2, np.zeros_like(counts)
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return out + 1


def _compare(table: pa.Table) -> pa.Table:
    """One block of a language: counts and, without an ordinal, a row of each source with
    its total → the differences of all pairs of sources, summed over the block."""
    frame = {c: table.column(c).to_numpy(zero_copy_only=False) for c in ("ordinal", "n", "v", "width")}
    names = np.array(table.column("source").to_pylist(), object)
    heads = np.isnan(frame["ordinal"].astype(float))
    totals = dict(zip(names[heads], frame["n"][heads].tolist()))
    sources = sorted(totals)
    v, width = int(frame["v"][heads][0]), int(frame["width"][heads][0])
    k = len(sources)
    sums = np.zeros((k, k), np.int64)
    if v:
        block = int(table.column("block")[0].as_py())
        counts = np.zeros((k, min(width, v - block * width)), np.int64)
        row = {s: i for i, s in enumerate(sources)}
        at = [row[s] for s in names[~heads]]
        counts[at, frame["ordinal"][~heads].astype(np.int64) - block * width] = frame["n"][~heads].astype(np.int64)
        p = np.stack([_billionths_of(c, totals[s] + 2 * v) for c, s in zip(counts, sources)])
        for i in range(k - 1):
            gap = p[i + 1:] - p[i]
            sums[i, i + 1:] = (gap * gap // (p[i + 1:] + p[i])).sum(axis=1)
    a, b = np.triu_indices(k, 1)
    lang = table.column("lang")[0].as_py()
    return pa.table([pa.array([lang] * len(a), pa.string()), pa.array([sources[i] for i in a], pa.string()),
                     pa.array([sources[i] for i in b], pa.string()), pa.array(sums[a, b])], ["lang", "a", "b", "value"])


def source_divergence(docs: DataFrame, text: str = "text", lang: str = "lang",
                      source: str = "source") -> DataFrame:
    """``(lang, source, part, item, value, rank)``: ``pair`` rows rank the other sources of
    the language by their difference, ``term`` rows a source's own terms."""
    texts = _texts(docs, text, lang, source)
    shards = written(vocabularies(texts), "numbered-transducers")
    # ranges of ordinals do not overlap, so the recounts of the groups are not summed again
    counts = _each_group(
        shards, "recounts", "lang string, source string, ordinal long, n long",
        lambda carried, schema: texts.mapInArrow(_recount(carried, HELD), schema)
        .groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n")))
    kept = shards.groupBy("lang").agg(F.sum("n").alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    g = written(texts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
                .join(kept, "lang", "left")
                .select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "v")]), "groups")
    of_lang = g.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count("*").alias("sources"))
    top = written(_own_terms(counts, g, of_lang), "own-terms")
    named = _each_group(
        shards, "named-terms", "lang string, source string, ordinal long, value long, rank int, item string",
        lambda carried, schema: top.mapInArrow(_decode(carried), schema))
    return _pairs(counts, g, of_lang).unionByName(
        named.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


def _each_group(shards: DataFrame, name: str, schema: str, step) -> DataFrame:
    """``step(carried transducers, schema)`` written for each group of them, together."""
    spark = shards.sparkSession
    out = spark.createDataFrame([], schema)
    for group in _groups(shards):
        carried = spark.sparkContext.broadcast(group)
        out = out.unionByName(written(step(carried, schema), name))
        carried.destroy()
    return out


def _pairs(counts: DataFrame, g: DataFrame, of_lang: DataFrame) -> DataFrame:
    width = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.expr(f"{CELLS} div sources"))).cast("long")
    wide = of_lang.select("lang", width.alias("width"))
    blocks = F.expr("sequence(0l, greatest(v - 1, 0) div width)")
    wide = broadcast_if_small(wide)
    heads = g.join(wide, "lang").select("lang", F.explode(blocks).alias("block"), "source",
                                        F.lit(None).cast("long").alias("ordinal"), "n", "v", "width")
    body = counts.join(wide, "lang").select(
        "lang", F.expr("ordinal div width").alias("block"), "source", "ordinal", "n",
        F.lit(0).cast("long").alias("v"), "width")
    sums = (heads.unionByName(body).groupBy("lang", "block")
            .applyInArrow(_compare, "lang string, a string, b string, value long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    both = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                   F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    rows = sums.select("lang", F.explode(both).alias("x"), "value").select("lang", "x.*", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return rows.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def _own_terms(counts: DataFrame, g: DataFrame, of_lang: DataFrame) -> DataFrame:
    """``(lang, source, ordinal, value, rank)``: each group's first terms, more frequent
    there than in the language."""
    in_lang = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("lang_count"))
    totals = g.join(broadcast_if_small(of_lang), "lang").withColumnRenamed("n", "total")
    rows = counts.join(in_lang, ["lang", "ordinal"]).join(broadcast_if_small(totals), ["lang", "source"])
    p = _billionths(F.col("n"), F.col("total"), F.col("v"))
    q = _billionths(F.col("lang_count"), F.col("lang_n"), F.col("v"))
    rows = rows.select("lang", "source", "ordinal", p.alias("p"), q.alias("q")).where("p > q")
    rows = rows.withColumn("value", F.expr("((p - q) * (p - q)) div (p + q)"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal"))
    return rows.select("lang", "source", "ordinal", "value", rank.alias("rank")).where(F.col("rank") <= TOP)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(read_table(spark, sf_dir, "documents"))


_RANGE = "\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F"
OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                               'abcdefghijklmnopqrstuvwxyz'), '[^{_RANGE}]+') AS terms FROM documents),
     t AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
     k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= {MIN_DOCS}),
     v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
     s AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
     g AS (SELECT DISTINCT lang, source FROM d),
     n AS (SELECT lang, source, coalesce(sum(s.n), 0) AS total FROM g LEFT JOIN s USING (lang, source) GROUP BY lang, source),
     p AS (SELECT g.lang, g.source, k.term, coalesce(s.n, 0) AS n,
                  (1 + (1000000000::HUGEINT * (coalesce(s.n, 0) + 2)) // (n.total + 2 * v.v))::HUGEINT AS p
           FROM g JOIN k USING (lang) JOIN v USING (lang) JOIN n USING (lang, source)
           LEFT JOIN s USING (lang, source, term)),
     q AS (SELECT lang, term, (1 + (1000000000::HUGEINT * (sum(p.n) + 2))::HUGEINT // (max(ln) + 2 * max(v.v)))::HUGEINT AS q
           FROM p JOIN v USING (lang) JOIN (SELECT lang, sum(total)::HUGEINT AS ln FROM n GROUP BY lang) USING (lang)
           GROUP BY lang, term),
     pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0) AS value
               FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
               LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
               LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
               GROUP BY a.lang, a.source, b.source),
     own AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value
             FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
     rows AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
              UNION ALL SELECT lang, source, 'term', item, value FROM own)
SELECT lang, source, part, item, value::BIGINT AS value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM rows QUALIFY part = 'pair' OR rank <= {TOP}
"""
