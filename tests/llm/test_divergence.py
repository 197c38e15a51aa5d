import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from phenoscope.llm import divergence as M
from phenoscope.llm import vocabulary as V


def _ordinals(fst, words):
    data = np.frombuffer(b"\n".join(words), np.uint8)
    return fst.ordinals(data, *V.term_places(data)).tolist()


def test_transducer_is_minimal_and_numbers_terms_in_byte_order():
    rng = random.Random(1)
    words = sorted({"".join(rng.choices("abé", k=rng.randint(1, 7))).encode() for _ in range(400)})
    fst = V.build(words)
    assert _ordinals(fst, words) == list(range(len(words))) and fst.size == len(words)
    assert [fst.term(i) for i in range(len(words))] == words
    others = [w for w in (w + b"x" for w in words)] + [w[:-1] for w in words if len(w) > 1 and w[:-1] not in words]
    assert set(_ordinals(fst, others)) == {-1}
    # minimal: as many states as different sets of endings
    endings = defaultdict(set)
    for w in words:
        for i in range(len(w) + 1):
            endings[w[:i]].add(w[i:])
    assert len(fst.final) == len({frozenset(e) for e in endings.values()})
    again = V.Transducer.load(fst.dump())
    assert _ordinals(again, words) == list(range(len(words)))
    with pytest.raises(ValueError):
        V.build([b"b", b"a"])


def test_ranges_of_a_vocabulary_give_global_ordinals():
    rng = random.Random(2)
    words = sorted({("samehead" * rng.randint(0, 2) + "".join(rng.choices("abc", k=rng.randint(1, 4)))).encode()
                    for _ in range(300)})
    for size in (1, 7, 100, 1000):
        shelf = V.Shelf([(words[i], words[i:i + size][-1], i, V.build(words[i:i + size]))
                         for i in range(0, len(words), size)])
        data = np.frombuffer(b"\n".join([*words, b"zz", b"samehea", b"b" * 9]), np.uint8)
        got = shelf.ordinals(data, *V.term_places(data)).tolist()
        assert got == [*range(len(words)), -1, -1, -1]
        assert [shelf.term(i) for i in range(len(words) + 1)] == [*words, None]


def test_pieces_cut_no_term():
    data = np.frombuffer("ab cdé fghijklmnop q rs".encode(), np.uint8)
    for limit in (1, 2, 5, 100):
        got = list(V.pieces(data, limit))
        assert b"".join(p.tobytes() for _, p in got) == data.tobytes()
        assert b" ".join(b" ".join(p.tobytes().split()) for _, p in got).split() == data.tobytes().split()


TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def _brute(docs, min_docs=10):
    rows = [(lang or "", source or "", [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")])
            for text, lang, source in docs]
    out = set()
    for lang in {r[0] for r in rows}:
        own = [(s, t) for x, s, t in rows if x == lang]
        df = Counter(t for _, terms in own for t in set(terms))
        kept = sorted((t for t, n in df.items() if n >= min_docs), key=str.encode)
        counts = defaultdict(Counter)
        for s, terms in own:
            counts[s].update(t for t in terms if t in set(kept))
        v, whole = len(kept), sum(counts.values(), Counter())

        def p(c, t):
            return 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * v)

        def ranked(items):
            return [(i, f, k + 1) for k, (i, f) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode())))]

        for s in counts:
            pairs = [(o, sum((p(counts[s], t) - p(counts[o], t)) ** 2 // (p(counts[s], t) + p(counts[o], t))
                             for t in kept)) for o in counts if o != s]
            terms = [(t, (p(counts[s], t) - p(whole, t)) ** 2 // (p(counts[s], t) + p(whole, t)))
                     for t in kept if counts[s][t] and p(counts[s], t) > p(whole, t)]
            out |= {(lang, s, "pair", *x) for x in ranked(pairs)}
            out |= {(lang, s, "term", *x) for x in ranked(terms)[:10]}
    return out


def _cases():
    rng = random.Random(3)
    words = ["Alpha", "beta", "BETA", "gämma", "Éa", "x", "日本", "q" * 300, *[f"w{chr(97 + k)}" for k in range(26)]]
    docs = [(" ".join(rng.choices(words, k=rng.randint(0, 25))) + rng.choice(["", "7a-b'c", "\u0000", "!"]),
             rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s2\u0000", "é", None])) for _ in range(220)]
    docs += [("only once here", "xx", "lone"), (None, "xx", "other"), ("", "yy", None), (None, None, None)]
    return docs + docs[:3] + [("beta wb " * 30_000, "en", "s1")]


def _run(spark, docs):
    df = spark.createDataFrame([(1, *d, "x", 5) for d in docs],
                               "doc_id long, text string, lang string, source string, term string, n int")
    out = M.source_divergence(df)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    rows = [tuple(r) for r in out.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_equals_brute_force(spark):
    docs = _cases()
    got = _run(spark, docs)
    assert got == _brute(docs)
    assert {r[2] for r in got} == {"pair", "term"} and len(got) > 50
    assert {(r[3], r[4]) for r in got if r[:2] == ("xx", "lone")} == {("other", 0)}


def test_many_shards_groups_and_blocks(spark, monkeypatch):
    docs = _cases()
    for name, value in (("SHARD_TERMS", 5), ("GROUP_BYTES", 1500), ("HELD", 40), ("CELLS", 12)):
        monkeypatch.setattr(M, name, value)
    shards = M.vocabularies(M._texts(spark.createDataFrame(docs, "text string, lang string, source string"),
                                     "text", "lang", "source"))
    assert len(list(M._groups(shards))) > 3
    assert _run(spark, docs) == _brute(docs)


def test_empty_table(spark):
    assert _run(spark, []) == set()


def test_long_texts_are_read_in_pieces(monkeypatch):
    text = ("Alpha bÉta-" * 40 + "x" * 90 + " last").encode()
    whole = M.terms_of(text)
    monkeypatch.setattr(M, "pieces", lambda data: V.pieces(data, 9))
    assert M.terms_of(text) == whole == {b"alpha", "bÉta".encode(), b"x" * 90, b"last"}
