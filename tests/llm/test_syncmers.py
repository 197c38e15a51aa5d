import hashlib
import random

import pytest
from pyspark.sql import functions as F

from phenoscope.llm import syncmers as Y


def test_anchors_are_those_with_the_smallest_part_at_an_edge():
    rng = random.Random(1)
    for alphabet in ("ab", "abcdefghé𝄞", "a"):
        text = "".join(rng.choices(alphabet, k=300))
        at, hashes = Y.anchors(text, 9, 4)
        parts = {}
        for i in range(len(text) - 4 + 1):
            # the hash of a part, read back from a text that is that part alone
            parts[i] = Y.anchors(text[i:i + 4], 4, 4)[1][0]
        want = [i for i in range(len(text) - 9 + 1)
                if min(parts[i + j] for j in range(6)) in (parts[i], parts[i + 5])]
        assert at.tolist() == want
        by_kmer = {}
        for i, h in zip(at.tolist(), hashes.tolist()):
            assert by_kmer.setdefault(text[i:i + 9], h) == h
        assert len(set(by_kmer.values())) == len(by_kmer)


def test_anchors_do_not_depend_on_context():
    rng = random.Random(2)
    passage = "".join(rng.choices("abcdefgh ", k=200))
    alone = set(Y.anchors(passage)[1].tolist())
    inside = set(Y.anchors("before " * 9 + passage + " after" * 9)[1].tolist())
    assert alone and alone <= inside


def test_likeness_and_short_texts(monkeypatch):
    rng = random.Random(3)
    a = "".join(rng.choices("abcdefghij ", k=3000))
    b = "".join(rng.choices("abcdefghij ", k=3000))
    fa, fb = Y.fingerprint(a), Y.fingerprint(b)
    assert Y.fingerprint(None) == Y.fingerprint("") == "" and len(Y.fingerprint("ab")) == 16
    assert Y.likeness(fa, fa) == 1 and Y.likeness("", "") == 1 and Y.likeness("", fa) == 0
    assert Y.likeness(fa, fb) < 0.05
    assert abs(Y.likeness(fa, Y.fingerprint(a[:2000] + b[:1000])) - 0.5) < 0.2
    monkeypatch.setattr(Y, "PIECE", 37)
    assert Y.fingerprint(a) == fa and len(fa) == 16 * Y.SKETCH


def _brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    out = []
    for k, (i, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(text) // 3
        edited = text[:len(text) - n] + following[:n]
        fp, other = Y.fingerprint(text), Y.fingerprint(edited)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), fp, other,
                    Y.likeness(fp, other), Y.likeness(fp, Y.fingerprint(following))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_rows", [1, 2, 7, 1000, None])
def test_next_document_over_blocks(spark, block_rows):
    rng = random.Random(5)
    rows = [(rng.randrange(-50, 10**12), "".join(rng.choices("abcé ", k=rng.randint(0, 90)))) for _ in range(60)]
    rows += [(None, "x" * 30), (None, None), (None, "b"), (max(r[0] for r in rows), "same id"), (7, None), (8, ""),
             rows[3], rows[3]]
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in rows],
                               "doc_id long, text string, block int, fingerprint string")
    got = sorted((tuple(r) for r in Y.compare_with_next(df, block_rows=block_rows).collect()), key=repr)
    assert got == _brute(rows)
    assert Y.compare_with_next(df.limit(0)).count() == 0
    one = df.where("doc_id = 8")
    assert [tuple(r) for r in Y.compare_with_next(one).collect()] == _brute([(8, "")])


def test_every_block_is_a_partition_however_many(spark, monkeypatch):
    monkeypatch.setattr(Y, "RESULT_CHARS", 50)
    rng = random.Random(6)
    rows = [(i * i - 10**6, "".join(rng.choices("abcé ", k=rng.randint(0, 90)))) for i in range(1_200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = Y.compare_with_next(df, block_rows=1)
    sizes = found.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 1_000 and max(r["count"] for r in sizes) <= 4
    assert sorted((tuple(r) for r in found.collect()), key=repr) == _brute(rows)


def test_ids_of_one_value_are_one_block(spark):
    rows = [(i, f"{c} of an id") for i in (7, None) for c in "zyxab"]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in Y.compare_with_next(df, block_rows=2).collect()), key=repr) == _brute(rows)


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in Y.op10_document_fingerprints(spark, sf).collect()), key=repr)
    assert got == _brute(rows)


def _words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(n))


def test_a_passage_of_100_words_in_two_long_texts():
    rng = random.Random(8)
    for _ in range(5):
        passage = _words(rng, 100)
        a, b = (" ".join((_words(rng, n), passage, _words(rng, 20_000 - n))) for n in (3_000, 15_000))
        fa, fb = Y.fingerprint(a), Y.fingerprint(b)
        assert len(fa) > 16 * Y.SKETCH and 0 < Y.likeness(fa, fb) < 0.01
        share = len(passage) / (len(a) + len(b) - len(passage))
        assert share / 4 < Y.likeness(fa, fb) < share * 4
        assert Y.likeness(fa, Y.fingerprint(_words(rng, 20_000))) == 0


def test_likeness_needs_the_same_order():
    rng = random.Random(9)
    blocks = [_words(rng, 60) for _ in range(40)]
    a = Y.fingerprint(" ".join(blocks))
    hashes = {a[i:i + 16] for i in range(0, len(a), 16)}
    mixed = Y.fingerprint(" ".join(blocks[::-1]))
    assert len(hashes & {mixed[i:i + 16] for i in range(0, len(mixed), 16)}) > 0.8 * len(hashes)
    assert Y.likeness(a, mixed) < 0.2
    assert Y.likeness(a, Y.fingerprint(" ".join(blocks[:20] + [_words(rng, 60)] + blocks[20:]))) > 0.9


def test_short_and_long_texts_compare_at_the_smaller_limit():
    rng = random.Random(10)
    long = _words(rng, 20_000)
    short = long[:6_000]
    assert abs(Y.likeness(Y.fingerprint(short), Y.fingerprint(long)) - 6_000 / len(long)) < 0.02
