import random

from phenoscope.llm import decontam as D

W = [f"w{i}" for i in range(40)] + ["Ünï", "Éa"]


def _shingles(text):
    words = D.words_of(text or "")
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def _brute(docs, items):
    out = []
    for d, t in docs:
        have = _shingles(t)
        for i, x in items:
            want = _shingles(x)
            if want and len(want & have) >= 0.8 * len(want) - 1e-9:
                out.append((d, i, len(want & have), len(want)))
    return sorted(out, key=repr)


def _cases():
    rng = random.Random(2)
    items = [(i, " ".join(rng.choices(W, k=rng.randint(5, 70)))) for i in range(40)]
    items += [(90, None), (91, ""), (92, "w1 w2 w3 w4"), (None, "w1 w2 w3 w4 w5 w6"), (3, items[3][1]),
              (93, "a a a a a a a a")]
    docs = []
    for d in range(150):
        words = rng.choices(W, k=rng.randint(0, 300))
        for i, x in rng.sample(items[:40], 2):
            part = x.split()
            for _ in range(rng.randint(0, 3)):  # altered copies on both sides of the threshold
                part[rng.randrange(len(part))] = rng.choice(W)
            if rng.random() < 0.2:  # scattered over the document
                cut = len(part) // 2
                words = part[:cut] + words + part[max(0, cut - 4):]
            else:
                at = rng.randint(0, len(words))
                words[at:at] = part
        docs.append((d, ", ".join(words).upper() if d % 2 else "\n".join(words)))
    return docs + [(200, None), (201, ""), (None, items[5][1]), (5, docs[5][1]),
                   (202, "a " * 30), (203, ("z " * 5000) + items[7][1] + " z" * 5000)], items


def test_search_equals_brute_force(spark, monkeypatch):
    docs, items = _cases()
    expected = _brute(docs, items)
    assert len(expected) > 100
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumnRenamed("text", "text")
    query = spark.createDataFrame(items, "item_id long, text string")
    for block in (D.BLOCK_ITEMS, 7):
        monkeypatch.setattr(D, "BLOCK_ITEMS", block)
        got = [tuple(r)[:4] for r in D.contaminated(df, query).collect()]
        assert sorted(got, key=repr) == expected
    gone = {e[0] for e in expected}
    kept = D.drop_contaminated(df, query).collect()
    assert sorted((r["doc_id"] for r in kept), key=repr) == \
        sorted((d for d, t in docs if d not in gone), key=repr)
    assert D.contaminated(df.limit(0), query).count() == 0
    assert D.contaminated(df, query.limit(0)).count() == 0
    assert D.drop_contaminated(df, query.limit(0)).count() == len(docs)


def test_long_text_in_pieces(monkeypatch):
    docs, items = _cases()
    index = D.ItemIndex(items)
    whole = [index.matches(t) for _, t in docs]
    monkeypatch.setattr(D, "PIECE", 50)
    assert [index.matches(t) for _, t in docs] == whole


def test_colliding_codes_are_told_apart(monkeypatch):
    docs, items = _cases()
    whole = [D.ItemIndex(items).matches(t) for _, t in docs]
    monkeypatch.setattr(D.ItemIndex, "_codes", staticmethod(lambda ids: (ids.sum(axis=1) % 5).astype("u8")))
    assert [D.ItemIndex(items).matches(t) for _, t in docs] == whole
