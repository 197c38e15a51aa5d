"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of the last ``WINDOW`` lines with text ends a chunk
wherever it is divisible by ``DIVISOR``, so boundaries depend on content alone and fall
into step again after lines were put in before them.

1. Chunks are grouped by hash.  One that occurs again anywhere is a repeat as a whole
   everywhere but at its first place (smallest document, then place).
2. A repeated passage need not hold a whole chunk.  Each two neighbouring lines with
   text (with the empty lines between them) are looked up as well, but only once for each
   different chunk and once for each boundary: what lies inside a repeated chunk was
   settled with it.  The pairs that continue each other, or a chunk, extend a match line by
   line to both sides, and they are the rule for passages without a whole chunk.
3. Repeats at one distance from one first place are joined to runs, and a run is
   removed after its bytes were compared with those of its first place: equal hashes
   alone remove nothing.

So a line goes if, and only if, the same line stands at an earlier place beside the same
neighbour (an occurrence that overlaps its first place in the same text stays), and
every line of every repeated passage of two or more lines is found.  ``WINDOW`` and
``DIVISOR`` change the work, not the result.  Single repeated lines stay.

Hashes and places are shuffled before any text; the text of first places is fetched
once per run and travels to the documents that repeat it.

A null text stays null, an empty text is one empty line.  Rows that repeat an
id and its text are one document and are treated alike.  A document may be left with
an empty text.  Ids that are null come after all others.  An empty table gives an
empty result; further columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read_table, same, strings, without, written

WINDOW = 2
DIVISOR = 8
MULTIPLIER = 1_000_003
#: A line of these characters alone has no text (fixed values: what ``str.strip`` removes).
BLANK = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _bytes(lines: list[str]) -> bytes:
    return "\n".join(lines).encode("utf-8", "surrogatepass")


def _chunked(text: str) -> tuple[list[str], list[int], list[tuple[int, int]]]:
    """The lines, the places of those with text, and of these ``(first, after the last)``
    of each chunk."""
    lines = text.split("\n")
    full = [i for i, line in enumerate(lines) if line.strip()]
    hashes = [xxhash.xxh32_intdigest(_bytes(lines[i:i + 1])) for i in full]
    chunks, rolling, start, drop = [], 0, 0, pow(MULTIPLIER, WINDOW, 1 << 32)
    for i, h in enumerate(hashes):
        rolling = rolling * MULTIPLIER + h
        if i >= WINDOW:
            rolling -= hashes[i - WINDOW] * drop
        rolling %= 1 << 32
        if rolling % DIVISOR == 0 or i == len(hashes) - 1:
            chunks.append((start, i + 1))
            start = i + 1
    return lines, full, chunks


def line_chunks(text: str) -> Iterator[tuple[int, int, str]]:
    """``(first line, line after the last, text)`` of each chunk, which starts and ends
    with a line with text."""
    lines, full, chunks = _chunked(text)
    for p, q in chunks:
        a, b = full[p], full[q - 1] + 1
        yield a, b, "\n".join(lines[a:b])


def line_pairs(text: str) -> Iterator[tuple[int, int, str]]:
    """``(first line, line after the last, text)`` of each two neighbouring lines with
    text and of the empty lines between them."""
    lines, full, _ = _chunked(text)
    for a, b in zip(full, full[1:]):
        yield a, b + 1, "\n".join(lines[a:b + 1])


_PAIR = pa.struct([("a", pa.int64()), ("b", pa.int64()), ("h", pa.int64())])


def _signed(digest: bytes) -> int:
    return int.from_bytes(digest, "big", signed=True)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each chunk: its place and hash, the pairs inside it (with places from
    its start) and the pair over its end."""
    for batch in batches:
        rows = []
        for i, text in enumerate(strings(batch, "text")):
            lines, full, chunks = _chunked(text or "")

            def pair(k: int, start: int) -> dict:
                a, b = full[k], full[k + 1] + 1
                return {"a": a - start, "b": b - start, "h": _signed(xxhash.xxh3_64_digest(_bytes(lines[a:b])))}

            for p, q in chunks:
                a, b = full[p], full[q - 1] + 1
                h = xxhash.xxh3_128_digest(_bytes(lines[a:b]))
                rows.append((i, a, b, _signed(h[:8]), _signed(h[8:]), [pair(k, a) for k in range(p, q - 1)],
                             pair(q - 1, 0) if q < len(full) else None))
        if rows:
            at, a, b, h1, h2, inside, over = map(list, zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)),
                 *[pa.array(x, pa.int64()) for x in (a, b, h1, h2)],
                 pa.array(inside, pa.list_(_PAIR)), pa.array(over, _PAIR)],
                ["id", "row", "a", "b", "h1", "h2", "inside", "over"])


def _laid_out(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` with the key of their rows, a struct of id and text hash (never null)."""
    return docs.withColumn("_phx_key", F.struct(F.col(doc_id).alias("id"), F.xxhash64(text).alias("row")))


def _without_cuts(kept: DataFrame, cuts: DataFrame, text: str, names: tuple[str, str]) -> DataFrame:
    """``kept`` (laid out) without those of its lines in ``cuts`` whose bytes are those of
    the first place.

    The join is a merge join at every size: its shuffle of the texts is then the one that
    the first texts were taken from."""
    whole = kept.join(cuts.select(F.struct("id", "row").alias("_phx_key"), "_phx_cuts").hint("merge"), "_phx_key", "left")
    inputs = [c for c in kept.columns if c != "_phx_key"]
    schema = T.StructType([f for f in kept.schema.fields if f.name != "_phx_key"]).add(names[0], "long").add(names[1], "long")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new, counts, removed = [], [], []
            for t, todo in zip(strings(batch, text), strings(batch, "_phx_cuts")):
                lines = [] if t is None else t.split("\n")
                gone = set()
                for c in todo or ():
                    if "\n".join(lines[c["a"]:c["b"]]) == c["first_text"]:
                        gone.update(range(c["a"], c["b"]))
                new.append("\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else t)
                counts.append(len(lines))
                removed.append(len(gone))
            columns = {n: batch.column(batch.schema.get_field_index(n)) for n in inputs}
            columns[text] = pa.array(new, pa.string())
            columns[names[0]] = pa.array(counts, pa.int64())
            columns[names[1]] = pa.array(removed, pa.int64())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return whole.mapInArrow(cut, schema)


def _spans(pieces: list) -> list[tuple[int, int]]:
    """Overlapping ``(a, b)`` joined, in order."""
    out: list[list[int]] = []
    for p in sorted((p["a"], p["b"]) for p in pieces):
        if out and p[0] < out[-1][1]:
            out[-1][1] = max(out[-1][1], p[1])
        else:
            out.append(list(p))
    return [(a, b) for a, b in out]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, spans = [], []
        for i, pieces in enumerate(strings(batch, "pieces")):
            for span in _spans(pieces):
                at.append(i)
                spans.append(span)
        if at:
            shift = batch.column(batch.schema.get_field_index("shift")).take(pa.array(at))
            a, b = (pa.array(x, pa.int64()) for x in zip(*spans))
            taken = [batch.column(batch.schema.get_field_index(n)).take(pa.array(at))
                     for n in ("id", "row", "first_id", "first_row")]
            yield pa.RecordBatch.from_arrays(
                [*taken, a, b, pc.subtract(a, shift), pc.subtract(b, shift)],
                ["id", "row", "first_id", "first_row", "a", "b", "first_a", "first_b"])


def _run_texts(column: str):
    # takes whole rows, so that the shuffle under it is the one of the cuts
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, a, b, texts = [], [], [], []
            for i, (text, wanted) in enumerate(zip(strings(batch, column), strings(batch, "wanted"))):
                lines = text.split("\n")
                for w in wanted:
                    at.append(i)
                    a.append(w["first_a"])
                    b.append(w["first_b"])
                    texts.append("\n".join(lines[w["first_a"]:w["first_b"]]))
            if at:
                key = batch.column(batch.schema.get_field_index("_phx_key")).take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*key.flatten(), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(texts, pa.string())],
                    ["first_id", "first_row", "first_a", "first_b", "first_text"])

    return run


def _pieces(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of ``docs(id, row, text)``: the chunks of several lines at all their places, the
    different ones with their first place, and the pairs inside those and over all ends."""
    id_type = docs.schema["id"].dataType.simpleString()
    pair = "struct<a: long, b: long, h: long>"
    chunks = written(docs.mapInArrow(_chunks, f"id {id_type}, row long, a long, b long, h1 long, h2 long, "
                                              f"inside array<{pair}>, over {pair}"), "chunks")
    several = chunks.where(F.size("inside") > 0)
    # merged in the tasks before the shuffle; the pairs follow from the chunk
    first = F.struct(F.col("id").isNull().alias("none"), "id", "row", "a", "b", "inside")
    contents = written(several.groupBy("h1", "h2").agg(F.min(first).alias("first"), F.count("*").alias("n")), "contents")
    inside = (contents.select("first.id", "first.row", F.col("first.a").alias("at"), F.explode("first.inside").alias("p"))
              .select("id", "row", (F.col("at") + F.col("p.a")).alias("a"), (F.col("at") + F.col("p.b")).alias("b"), "p.h"))
    over = chunks.where("over is not null").select("id", "row", "over.a", "over.b", "over.h")
    return several.drop("inside", "over"), contents, inside.unionByName(over)


def _repeats(docs: DataFrame) -> DataFrame:
    """``docs(id, row, text)`` → ``(id, row, a, b, first_id, first_row, first_a, first_b)``:
    the chunks and pairs that stand at an earlier place, not yet compared."""
    chunks, contents, pairs = _pieces(docs)
    place = F.struct(F.col("id").isNull().alias("none"), "id", "row", "a", "b")
    first = F.struct(*[f"first.{c}" for c in ("none", "id", "row", "a", "b")]).alias("first")
    again = (chunks.join(contents.where("n > 1").select("h1", "h2", first), ["h1", "h2"])
             .where(~same(place, F.col("first"))))
    repeated = pairs.groupBy("h").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    in_first = same(F.col("id"), F.col("first.id")) & (F.col("row") == F.col("first.row"))
    beside = pairs.join(repeated, "h").where(~in_first | (F.col("a") >= F.col("first.b")))
    columns = ["id", "row", "a", "b", *[F.col(f"first.{c}").alias(f"first_{c}") for c in ("id", "row", "a", "b")]]
    return again.select(*columns).unionByName(beside.select(*columns))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                names: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """``docs`` with every repeated passage of two or more lines cut out of the text but
    at its first place, and under ``names`` how many lines there were and are gone."""
    kept = without(docs, *names)
    keyed = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("row"),
                        F.col(text).alias("text"))
    id_type = keyed.schema["id"].dataType.simpleString()
    runs = (_repeats(keyed)
            .groupBy("id", "row", "first_id", "first_row", (F.col("a") - F.col("first_a")).alias("shift"))
            .agg(F.collect_set(F.struct("a", "b")).alias("pieces"))
            .mapInArrow(_runs, f"id {id_type}, row long, first_id {id_type}, first_row long, "
                               "a long, b long, first_a long, first_b long"))
    runs = written(runs, "runs")
    wanted = (runs.groupBy("first_id", "first_row")
              .agg(F.collect_set(F.struct("first_a", "first_b")).alias("wanted")))
    # rows that repeat a first place give its text once
    laid_out = _laid_out(kept, doc_id, text)
    wanted = wanted.select(F.struct(F.col("first_id").alias("id"), F.col("first_row").alias("row")).alias("_phx_key"), "wanted")
    firsts = (laid_out.join(wanted.hint("merge"), "_phx_key")
              .mapInArrow(_run_texts(text), f"first_id {id_type}, first_row long, first_a long, first_b long, "
                                      "first_text string")
              .dropDuplicates(["first_id", "first_row", "first_a", "first_b"]))
    r, f = runs.alias("r"), firsts.alias("f")
    found = r.join(f, same(F.col("r.first_id"), F.col("f.first_id"))
                   & (F.col("r.first_row") == F.col("f.first_row"))
                   & (F.col("r.first_a") == F.col("f.first_a")) & (F.col("r.first_b") == F.col("f.first_b")))
    cuts = found.groupBy("r.id", "r.row").agg(F.collect_list(F.struct("r.a", "r.b", "f.first_text")).alias("_phx_cuts"))
    return _without_cuts(laid_out, cuts, text, names)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


OP4_SQL = rf"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                  unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
     k AS (SELECT *, max(CASE WHEN regexp_matches(line, '[^{BLANK}]') THEN i END) OVER
                  (PARTITION BY doc_id ORDER BY i) AS a FROM l),
     t AS (SELECT doc_id, a, string_agg(line, chr(10) ORDER BY i) AS block, min_by(line, i) AS line
           FROM k WHERE a IS NOT NULL GROUP BY doc_id, a),
     p AS (SELECT doc_id, a, lead(a) OVER w + 1 AS b, block || chr(10) || lead(line) OVER w AS pair
           FROM t WINDOW w AS (PARTITION BY doc_id ORDER BY a)),
     f AS (SELECT *, first_value(doc_id) OVER w AS first_doc, first_value(b) OVER w AS first_b
           FROM p WHERE b IS NOT NULL WINDOW w AS (PARTITION BY pair ORDER BY doc_id, a)),
     g AS (SELECT DISTINCT doc_id, unnest(range(a, b)) AS i FROM f WHERE doc_id <> first_doc OR a >= first_b)
SELECT d.doc_id,
       CASE WHEN d.text IS NOT NULL
            THEN coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '') END AS text,
       count(l.i) AS n_lines, count(g.i) AS n_removed
FROM documents d LEFT JOIN l USING (doc_id) LEFT JOIN g ON g.doc_id = l.doc_id AND g.i = l.i
GROUP BY d.doc_id, d.text
"""
