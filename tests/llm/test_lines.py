import random

import pyarrow as pa
from pyspark.sql import functions as F

from phenoscope.llm import lines as M

L = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", ""]


def _brute(docs):
    """docs: (id, text), ids distinct and in order.  Every pair of neighbouring lines with
    text is looked up among all earlier ones."""
    first, out = {}, []
    for d, text in docs:
        if text is None:
            out.append((d, None, 0, 0))
            continue
        lines, gone = text.split("\n"), set()
        for a, b, pair in M.line_pairs(text):
            place = first.setdefault(pair, (d, a, b))
            if place[0] != d or a >= place[2]:
                gone.update(range(a, b))
        out.append((d, "\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone)))
    return out


def _colliding():
    """Chunks and pairs that all have one hash."""
    plain = M._chunks

    def collide(batches):
        for batch in plain(batches):
            zero = pa.array([0] * len(batch), pa.int64())
            inside, over = (batch.column(i).to_pylist() for i in (6, 7))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], zero, zero,
                 pa.array([[{**p, "h": 0} for p in x] for x in inside], batch.schema.field("inside").type),
                 pa.array([x and {**x, "h": 0} for x in over], batch.schema.field("over").type)],
                batch.schema.names)

    return collide


def _cases():
    rng = random.Random(4)
    passages = ["\n".join(rng.choices(L, k=9)) for _ in range(6)]
    docs = []
    for d in range(80):
        parts = ["\n".join(rng.choices(L, k=rng.randint(0, 6))) for _ in range(3)]
        parts.insert(1, rng.choice(passages))
        docs.append((d, "\n".join(parts)))
    return docs + [(100, None), (101, ""), (102, docs[3][1]), (103, "\n" * 50), (104, "one line"),
                   (105, "\n".join(["same"] * 400)), (106, "x" * 200_000 + "\n" + passages[0])]


def test_equals_brute_force(spark):
    docs = _cases()
    df = spark.createDataFrame([(d, t, -1, "h") for d, t in docs],
                               "doc_id long, text string, n_lines int, h1 string")
    got = sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_removed"])
                  for r in M.dedup_lines(df).collect()))
    assert got == _brute(docs)
    assert sum(g[3] for g in got) > 200
    assert M.dedup_lines(df).columns == ["doc_id", "text", "h1", "n_lines", "n_removed"]
    assert M.dedup_lines(df.limit(0)).count() == 0


def test_equal_hashes_with_other_bytes_remove_nothing(spark, monkeypatch):
    monkeypatch.setattr(M, "_chunks", _colliding())
    df = spark.createDataFrame([(1, "a\nb"), (2, "c\nd"), (3, "a\nb")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["text"]) for r in M.dedup_lines(df).collect())
    assert got == [(1, "a\nb"), (2, "c\nd"), (3, "")]


def test_boundaries_come_back_after_an_insertion():
    rng = random.Random(9)
    lines = [f"line {rng.random()}" for _ in range(60)]
    a = {c for _, _, c in M.line_chunks("\n".join(lines))}
    b = {c for _, _, c in M.line_chunks("\n".join(["new first line", *lines]))}
    assert len(a & b) >= len(a) - 2  # the first line's window is another one


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "p\nq\nr\ns\nt"), (1, "p\nq\nr\ns\nt"), (None, "p\nq\nr\ns\nt"), (0, "p\nq\nr\nother\nt")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc_id"], r["text"]) for r in M.dedup_lines(df).collect()]
    assert len(got) == 4 and got.count((1, "p\nq\nr\ns\nt")) in (0, 2)
    assert got.count((0, "p\nq\nr\nother\nt")) == 1
    null_left = next(t for d, t in got if d is None)
    assert len(null_left) < len("p\nq\nr\ns\nt")


def test_every_short_passage_is_found(spark):
    rng = random.Random(11)
    passages = [[f"passage {n} {k} {rng.random()}" for k in range(n)] for n in (2, 3, 4, 5, 6) for _ in range(30)]
    docs = []
    for d in range(300):
        own = [f"own {d} {k}" for k in range(rng.randint(2, 8))]
        at = rng.randint(0, len(own))
        docs.append((d, "\n".join(own[:at] + passages[d % 150] + own[at:])))
    got = {r["doc_id"]: r["text"] for r in M.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for d, text in docs:
        left = [x for x in got[d].split("\n") if x.startswith("passage")]
        assert left == (passages[d] if d < 150 else [])
        assert got[d].count("own") == text.count("own")


def test_empty_lines_between_and_lines_left(spark):
    docs = [*_cases(), (107, "a\n\nb\n \nc"), (108, "x\na\n\nb\ny"), (109, "\n".join(["p", "q"] * 40))]
    got = sorted(tuple(r) for r in M.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert got == _brute(docs)
    assert dict((g[0], g[1]) for g in got)[108] == "x\ny"
    # each line with text that stood anywhere still stands somewhere
    left = {x for g in got if g[1] for x in g[1].split("\n")}
    assert {x for _, t in docs if t for x in t.split("\n") if x.strip()} <= left


def test_documents_of_many_thousand_lines(spark):
    rng = random.Random(3)
    long = [f"line {rng.randint(0, 10**9)}" for _ in range(20_000)]
    docs = [(1, "\n".join(long)), (2, "\n".join(["new", *long[:9000], "between", "between", *long[9000:]])),
            (3, "\n".join(long[5000:5002])), (4, "\n".join(["p", "q", ""] * 5000))]
    got = sorted(tuple(r) for r in M.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert got == _brute(docs)
    assert got[1][1] == "new\nbetween\nbetween" and got[2][1] == ""


def test_pairs_inside_repeated_chunks_are_looked_up_once(spark):
    rng = random.Random(8)
    docs = [[f"line {rng.random()}" for _ in range(40)] for _ in range(50)]
    docs += [docs[0]] * 50  # a hot text: half of all rows
    df = spark.createDataFrame([(d, "\n".join(x)) for d, x in enumerate(docs)], "doc_id long, text string")
    chunks, contents, pairs = M._pieces(df.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("row"), "text"))
    assert chunks.count() + pairs.count() < 0.9 * sum(len(x) - 1 for x in docs)
    assert contents.agg(F.sum("n")).first()[0] == chunks.count()


def test_repeated_rows_with_equal_hashes(spark, monkeypatch):
    rows = [(1, "p\nq"), (1, "p\nq"), (None, "p\nq"), (2, "r\ns")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = [(0, ""), (1, "p\nq"), (1, "p\nq"), (2, "r\ns")]
    assert sorted((r["doc_id"] or 0, r["text"]) for r in M.dedup_lines(df).collect()) == want
    monkeypatch.setattr(M, "_chunks", _colliding())
    assert sorted((r["doc_id"] or 0, r["text"]) for r in M.dedup_lines(df).collect()) == want
