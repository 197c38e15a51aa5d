import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from phenoscope.llm import simhash as S
from phenoscope.llm.common import connected_components


def _plain(text, width=4):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def _roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprint_matches_the_plain_rule(monkeypatch):
    texts = [None, "", " \t\n", "One", "a b c", "A b C d e f é\x0bg\x85h", "x " * 50, "É é A a " * 9]
    for piece in (S.PIECE, 5):
        monkeypatch.setattr(S, "PIECE", piece)
        assert [S.simhash(t) for t in texts] == [_plain(t) for t in texts]


def test_bucket_links_equal_brute_force(monkeypatch):
    rng = random.Random(3)
    seeds = [rng.getrandbits(64) for _ in range(12)] + [0, 2**64 - 1]
    fps = set(seeds)
    for s in seeds:
        for _ in range(25):
            x = s
            for _ in range(rng.randint(1, 6)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = np.array(sorted(fps), np.uint64)
    links = [(i, j) for i in range(len(fps)) for j in range(i) if int(fps[i] ^ fps[j]).bit_count() <= 4]
    expected = _roots(range(len(fps)), links)
    for slice_size in (S.SLICE_VARIANTS, 1000):
        monkeypatch.setattr(S, "SLICE_VARIANTS", slice_size)
        got = [p for k in range(8) for p in zip(*map(np.ndarray.tolist, S.bucket_links(fps, k, 3, 2)))]
        assert _roots(range(len(fps)), got) == expected
        assert len(got) < 8 * len(fps)


def test_no_bucket_is_large_whatever_the_family(spark, monkeypatch):
    rng = random.Random(4)
    seed, fps = rng.getrandbits(64), {0, 2**64 - 1}
    while len(fps) < 900:  # a third differs in few places, and not in the lowest bits
        x = seed if len(fps) < 300 else rng.getrandbits(64)
        for step, place in enumerate(rng.sample(range(30, 64), 7)):
            x ^= 1 << place
            if step >= 4:
                fps.add(x)
    fps = sorted(fps)
    links = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    expected = _roots(range(len(fps)), links)
    prints = spark.createDataFrame([(x - (x >> 63 << 64),) for x in fps], "fp long")
    place = {x - (x >> 63 << 64): i for i, x in enumerate(fps)}
    monkeypatch.setattr(S, "DEALT", 100)
    for limit in (1 << 20, 150):
        monkeypatch.setattr(S, "BUCKET_PRINTS", limit)
        sizes = {r["bucket"]: r["n"] for r in S.dealt(prints, 2).groupBy("bucket").agg(
            (F.sum(F.octet_length("fps")) / 8).alias("n")).collect()}
        assert max(sizes.values()) <= limit
        if limit == 150:
            assert len({b.bit_length() for b in sizes}) > 2
            assert S._depth(len(fps), 2) > S.LEAST_DEPTH
        got = [(place[r["a"]], place[r["b"]]) for r in S.fingerprint_links(prints).collect()]
        assert _roots(range(len(fps)), got) == expected


def test_depth_grows_with_the_fingerprints_and_buckets_do_not():
    for n in (10**3, 10**6, 10**9, 10**11):
        depth = S._depth(n, 2)
        assert n * len(S._ball(depth, 2)) >> depth <= S.BUCKET_PRINTS // 4
        assert n * 2081 >> depth <= S.BUCKET_VARIANTS and len(S._ball(depth, 2)) < 450


def test_components_of_a_table(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(30)] + [(7, 7)] \
        + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    nodes = {n for a, b in links if a != b for n in (a, b)}
    got = {r["node"]: r["root"] for r in
           connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == _roots(nodes, links)


def _near(spark, rows, schema="doc_id long, text string, fp string"):
    return S.near_duplicates(spark.createDataFrame(rows, schema))


def test_edge_cases(spark):
    rows = [(3, None, "x"), (2, "", "x"), (5, "  ", "x"), (9, "some words that stand alone here", "x"),
            (8, "SOME words  that stand alone here", "x"), (8, "SOME words  that stand alone here", "x"),
            (None, "some words that stand alone here", "x"), (None, "a text nobody else has got", "x")]
    got = sorted(((r["doc_id"], r["component_id"]) for r in _near(spark, rows).collect()),
                 key=lambda x: (x[0] is None, x[0] or 0))
    assert got[:6] == [(2, 2), (3, 2), (5, 2), (8, 8), (8, 8), (9, 8)]
    assert sorted(got[6:], key=repr) == [(None, 8), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    kept = S.drop_near_duplicates(docs).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], r["text"]) for r in kept if r["doc_id"]) == \
        [(False, 2, ""), (False, 8, "SOME words  that stand alone here")]
    assert len(kept) == 3 and kept[0].__fields__ == docs.columns
    assert _near(spark, rows[:0]).count() == 0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    fp = {i: _plain(t) for i, t in texts.items()}
    ids = sorted(fp)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[:n] if (fp[a] ^ fp[b]).bit_count() <= 4]
    expected = _roots(ids, links)
    got = S.op5_simhash_near_dedup(spark, sf).collect()
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got} == \
        {(i, f"{fp[i]:016x}", expected[i]) for i in ids}
