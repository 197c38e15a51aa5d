import hashlib
import random

import numpy as np

from phenoscope.llm import suffix as S


def _brute_windows(contents, places, length):
    seen = {}
    for i, c in enumerate(contents):
        for o in range(len(c) - length + 1):
            place = tuple(p[i] for p in places[:3]) + (places[3][i] + o,)
            seen.setdefault(c[o:o + length], []).append((place, i, o))
    return {(i, o) for v in seen.values() for p, i, o in v if p != min(x[0] for x in v)}


def test_interval_expansion_finds_all_equal_windows():
    rng = random.Random(1)
    for _ in range(200):
        length = rng.choice([8, 9, 10, 20, 100])
        alphabet = rng.choice([b"ab", b"abcdefgh", b"a", bytes(range(256))])
        contents = [bytes(rng.choices(alphabet, k=rng.randint(length, length + 60)))
                    for _ in range(rng.randint(1, 8))]
        if rng.random() < 0.5:
            contents.append(contents[0][3:] + b"zz" + contents[-1])
        contents = [c for c in contents if len(c) >= length]
        n = len(contents)
        places = [np.array([rng.random() < 0.1 for _ in range(n)]),
                  np.array([rng.randint(0, 3) for _ in range(n)]), np.zeros(n, int),
                  np.array([rng.randint(0, 30) for _ in range(n)])]
        got = {(int(c), int(o) + j) for c, o, k in zip(*S.repeated_windows(contents, places, length))
               for j in range(int(k))}
        assert got == _brute_windows(contents, places, length)


def test_runs_cover_every_window_and_equal_windows_share_a_hash():
    rng = random.Random(2)
    for alphabet in (b"a", b"ab", bytes(range(97, 123))):
        data = bytes(rng.choices(alphabet, k=700))
        data += data[100:350]
        start, n, value, again = S.window_runs(data)
        assert start[0] == 0 and (start[1:] == (start + n)[:-1]).all() and (start + n)[-1] == len(data) - 99
        by_window, where = {}, {}
        for a, k, v, g in zip(start.tolist(), n.tolist(), value.tolist(), again.tolist()):
            for w in range(a, a + k):
                text = data[w:w + 100]
                assert by_window.setdefault(text, v) == v
                if where.setdefault(text, a) == a and text in [data[x:x + 100] for x in range(a, w)]:
                    assert g


def _brute(docs, length=100):
    """docs: (id, bytes) in order, ids distinct."""
    seen, out = set(), []
    for d, data in docs:
        gone = bytearray(len(data))
        for o in range(len(data) - length + 1):
            k = data[o:o + length]
            if k in seen:
                gone[o:o + length] = b"\1" * length
            seen.add(k)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out.append((d, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def _digest(frame):
    return sorted(((r["doc_id"], len((r["text"] or "").encode()),
                    sum(s["end"] - s["start"] for s in r["removed"]), len(r["removed"]),
                    hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in frame.collect()),
                  key=lambda r: (r[0] is None, r[0] or 0))


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = sorted((r["doc_id"], r["text"].encode())
                  for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    got = sorted(tuple(r) for r in S.op6_suffix_dedup(spark, sf).collect())
    assert got == _brute(docs)


def test_odd_texts(spark, monkeypatch):
    rng = random.Random(3)
    base = "".join(rng.choices("abcdé ", k=400))
    rows = [(7, base), (3, "x" + base[50:300] + "y" + base[60:200]), (1, None), (2, ""), (4, "a" * 1000),
            (5, "a" * 99), (6, "ab" * 300 + "a" * 120), (8, base * 3), (9, "é" * 120), (None, base[:150])]
    df = spark.createDataFrame([(d, t, "k", -1) for d, t in rows], "doc_id long, text string, kept string, m int")
    for batch, hot in ((10_000, S.HOT_BYTES), (3, 500)):
        monkeypatch.setattr(S, "HOT_BYTES", hot)  # with 500, a second hash deals out most runs
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        got = _digest(S.remove_repeats(df))
        ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
        assert got == _brute([(d, (t or "").encode()) for d, t in ordered])
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert S.remove_repeats(df).columns == ["doc_id", "text", "m", "removed", "kept"]
    assert S.remove_repeats(df.limit(0)).count() == 0
    twice = df.where("doc_id = 7").unionByName(df.where("doc_id = 7"))
    assert [r[2] for r in _digest(S.remove_repeats(twice))] == [0, 0]


def test_copies_that_meet_across_batches(spark):
    rng = random.Random(5)
    text = "".join(rng.choices("abcdefgh ", k=1500))
    rows = [(d, text) for d in range(6)] + [(6, "x" + text[200:900]), (7, text[100:199]), (8, text[100:200])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    got = _digest(S.remove_repeats(df))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == _brute([(d, t.encode()) for d, t in rows])
    assert [r[2] for r in got] == [0, *[1500] * 5, 700, 0, 100]


def test_long_texts_in_pieces(monkeypatch):
    rng = random.Random(4)
    data = bytes(rng.choices(b"abc", k=900))
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([data], pa.binary())],
                                       ["id", "row", "data"])
    monkeypatch.setattr(S, "PIECE", 150)
    out = pa.Table.from_batches(list(S._runs(100)(iter([batch]))))
    covered = sorted(w for x in out["an"].to_pylist() for w in
                     range(x >> S.N_BITS, (x >> S.N_BITS) + x % (1 << S.N_BITS)))
    assert covered == list(range(801))
