import itertools

import numpy as np

from phenoscope.llm import language as L


def _brute(scores, switch):
    k = scores.shape[1]
    best, path = -np.inf, None
    for p in itertools.product(range(k), repeat=len(scores)):
        v = sum(scores[i, c] for i, c in enumerate(p)) - switch * sum(a != b for a, b in zip(p, p[1:]))
        if v > best:
            best, path = v, p
    return best, path


def _value(scores, path, switch):
    return (scores[np.arange(len(path)), path].sum()
            - switch * sum(a != b for a, b in zip(path, path[1:])))


def test_viterbi_is_the_best_path_over_block_edges(monkeypatch):
    rng = np.random.RandomState(1)
    for block in (2, 3, 32):
        monkeypatch.setattr(L, "_BLOCK", block)
        for _ in range(30):
            counts = rng.randint(1, 8, 4)
            scores = rng.randint(-6, 6, (counts.sum(), 3)).astype(np.float32)
            got, at = L._viterbi(scores, counts, 3.0), 0
            for n in counts:
                part = scores[at:at + n]
                assert _value(part, got[at:at + n], 3.0) == _brute(part, 3.0)[0]
                at += n


TRAIN = ([("the quick brown fox jumps over the lazy dog and runs away", "en"),
          ("der schnelle braune fuchs springt über den faulen hund und rennt", "de"),
          ("быстрая коричневая лиса прыгает через ленивую собаку", "ru")] * 5
         + [(None, "en"), ("no language", None), ("", "de")])


def _frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string")


def test_spans_scripts_and_edge_cases(spark):
    model = L.fit_language_model(_frame(spark, TRAIN))
    assert model.langs == ["de", "en", "ru"]
    text = "the lazy dog and the brown fox 123 быстрая лиса прыгает"
    docs = spark.createDataFrame(
        [(1, text, 1), (2, None, 1), (3, "", 1), (4, "12 !! 3 \u0301", 1), (5, "den faulen hund", 1),
         (5, "den faulen hund", 1), (6, "x" * 3_000_000, 1)], "doc_id long, text string, score int")
    rows = L.identify_language(docs, model).orderBy("doc_id").collect()
    assert rows[0].__fields__ == ["doc_id", "text", "lang_pred", "score", "lang_spans"]
    spans = [(s["lang"], text[s["start"]:s["end"]]) for s in rows[0]["lang_spans"]]
    assert spans == [("en", "the lazy dog and the brown fox"), ("ru", "быстрая лиса прыгает")]
    assert rows[0]["lang_pred"] == "en" and 0.5 < rows[0]["score"] < 1
    for r in rows[1:4]:
        assert (r["lang_pred"], r["score"], r["lang_spans"]) == ("und", 0.0, [])
    assert rows[4]["lang_pred"] == "de" and rows[4] == rows[5]
    assert rows[6]["lang_pred"] in model.langs and 0 <= rows[6]["score"] <= 1
    assert L.identify_language(docs.limit(0), model).count() == 0


def test_no_training_rows(spark):
    model = L.fit_language_model(_frame(spark, TRAIN).limit(0))
    assert [r["lang_pred"] for r in L.identify_language(_frame(spark, TRAIN), model).collect()] \
        == ["und"] * len(TRAIN)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = L.op2_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id")
    rows = found.where("held_out and lang_pred <> 'und'").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows) > 200
