import json
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from phenoscope.llm import token_files as M

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(M.TOKENIZER)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def _digests(docs, plain):
    """``docs``: (id, text) in the order of the files."""
    out, start = [], 0
    for i, text in docs:
        ids = [*plain(text), 0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


ODD = ["", " ", "\n\n", " a", "a  b", "a \n b", "it's we'll  don't ", "x \n\ny", "a\x1cb \x1c c", "!\x85 z", "日本 語",
       "tab\t\ttab", "<|endoftext|> <|endoftext|>x", "\u00a0\u00e9 \u200b  q", "99 bottles, 1,000\r\n", "\ufeffhead \u2003 "]


class _Counting:
    def __init__(self, tokenizer, blank=True):
        self.tokenizer, self.blank, self.texts = tokenizer, blank, 0

    def get_vocab(self):
        return self.tokenizer.get_vocab() if self.blank else {"a": 0, "b": 60_000}

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_unknown_words_of_a_text_are_encoded_together(plain):
    words = [f"{a}{b}x\xe9" for a in "abcdefgh" for b in "qzjv"]
    text = " ".join(words) + ", it's  two \xb5 \u01c5x \U0001f600 end\n last"
    together = _Counting(Tokenizer.from_file(M.TOKENIZER))
    encoder = M.Encoder(together)
    for _ in range(2):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == plain(text)
    assert together.texts < len(words)
    # without tokens for blanks the words cannot be told apart, so each is encoded by itself
    alone = _Counting(Tokenizer.from_file(M.TOKENIZER), blank=False)
    assert np.frombuffer(M.Encoder(alone).encode(text), "<u4").tolist() == plain(text)
    assert alone.texts > len(words)


class _Calls(_Counting):
    calls = 0

    def encode_batch_fast(self, texts, **options):
        self.calls += 1
        return super().encode_batch_fast(texts, **options)


def test_many_texts_are_cut_and_encoded_at_once(plain, monkeypatch):
    with open(M.TOKENIZER, encoding="utf-8") as f:
        source = f.read()
    rng = random.Random(7)
    texts = [" ".join("".join(rng.choices("abcdezq\xe9\xd8\xdf", k=rng.randrange(1, 14))) for _ in range(30)) for _ in range(300)]
    texts += [*ODD, "\xd7a\xf7b \xc3\u0120x", "", " ".join(ODD), "a,b.c don't\n\n x"] * 3
    rng.shuffle(texts)
    expected = [plain(t) for t in texts]
    rest, words = _Calls(Tokenizer.from_str(source)), _Calls(M.word_tokenizer(source))
    rest.tokenizer.encode_special_tokens = True
    encoder = M.Encoder(rest, words)
    ids, n = encoder.encode_all(texts)
    assert n.tolist() == list(map(len, expected)) and ids.tolist() == sum(expected, [])
    # not a call for each text, and no piece again
    assert words.calls + rest.calls < 20
    done = words.texts, rest.texts
    assert encoder.encode_all(texts)[0].tolist() == ids.tolist() and (words.texts, rest.texts) == done

    # a full memory keeps what was used again, and whatever it holds, the ids are the same
    monkeypatch.setattr(M, "REMEMBERED", 4_000)
    monkeypatch.setattr(M, "SLICE", 2_000)
    monkeypatch.setattr(M, "TOGETHER", 7)
    encoder = M.Encoder(Tokenizer.from_str(source), M.word_tokenizer(source))
    for _ in range(2):
        assert encoder.encode_all(texts)[0].tolist() == ids.tolist()
        assert len(encoder.known) == len(encoder.ids) == len(encoder.used) < 1_000
    assert encoder.encode_all([])[0].tolist() == encoder.encode_all(["", ""])[0].tolist() == []


def test_words_are_cut_as_the_file_says(plain):
    with open(M.TOKENIZER, encoding="utf-8") as f:
        spec = json.load(f)
    for change in {"use_regex": False}, {"add_prefix_space": True}:
        assert M.word_tokenizer(json.dumps({**spec, "pre_tokenizer": {**spec["pre_tokenizer"], **change}})) is None
    assert M.word_tokenizer(json.dumps({**spec, "normalizer": {"type": "Lowercase"}})) is None


def test_pieces_give_the_ids_of_the_whole(plain, monkeypatch):
    encoder = M.Encoder(Tokenizer.from_file(M.TOKENIZER))
    for text in [*ODD, " ".join(ODD), "".join(ODD)]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == plain(text), text
    monkeypatch.setattr(M, "REMEMBERED", 500)
    monkeypatch.setattr(M, "segments", lambda t, f=M.segments: f(t, 9))
    for text in [*ODD, " ".join(ODD) * 3, "word, " * 40]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == plain(text), text


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r'sA1.\u00e9\u3000\xa0\x1c"), st.characters(codec="utf-8")), max_size=60))
def test_any_text(text):
    tokenizer = Tokenizer.from_file(M.TOKENIZER) if not hasattr(test_any_text, "t") else test_any_text.t
    test_any_text.t = tokenizer
    encoder = M.Encoder(tokenizer)
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_query_equals_one_pass_in_order(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r) for r in M.op12_token_files(spark, SF).orderBy("doc_id").collect()]
    assert got == _digests(sorted(map(tuple, docs)), plain)


def test_odd_rows(spark, tmp_path, plain):
    rng = random.Random(4)
    rows = [(i, rng.choice(ODD)) for i in range(-30, 60)] + [(7, None), (8, "long text " * 60_000)]
    rows = {i: (i, t) for i, t in rows}.values()
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, n int, ids string, part int")
    schema = M.write_token_files(df.repartition(5), str(tmp_path / "a"))
    got = M.token_digests(M.read_token_files(spark, str(tmp_path / "a"), schema)).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == _digests(sorted(rows), plain)

    # null and repeated ids: null first, ids of all documents without gap or overlap
    rows = [(None, "n one"), (None, "n two"), (3, "same"), (3, "same"), (3, "other"), (1, "first")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string")
    schema = M.write_token_files(df, str(tmp_path / "b"))
    got = sorted(map(tuple, M.token_digests(M.read_token_files(spark, str(tmp_path / "b"), schema)).collect()),
                 key=lambda r: r[1])
    assert [r[0] for r in got] == [None] * 6 + [1] * 3 + [3] * 9
    assert [r[1] for r in got] == np.cumsum([0, *[r[2] for r in got]])[:-1].tolist()
    assert sorted((r[0] or 0, r[3]) for r in got) == sorted((r[0] or 0, r[3]) for r in _digests(rows, plain))

    schema = M.write_token_files(df.limit(0), str(tmp_path / "c"))
    assert M.token_digests(M.read_token_files(spark, str(tmp_path / "c"), schema)).collect() == []


def test_files_follow_each_other_and_metadata_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(40_000).selectExpr("id * 10 AS doc_id", "concat('text of ', id, repeat(' more words', id % 40)) AS text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    schema = M.write_token_files(df, path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    rows = M.read_token_files(spark, path, schema)
    ends = rows.groupBy("part").agg({"doc_id": "min", "place": "min"}).join(
        rows.groupBy("part").agg({"doc_id": "max"}), "part").orderBy("part").collect()
    assert len(ends) == 8 and all(a["max(doc_id)"] < b["min(doc_id)"] for a, b in zip(ends, ends[1:]))
    assert {r["min(place)"] for r in ends} == {0}

    def read(doc_ids):
        found = M.read_token_files(spark, path, schema, doc_ids).select("doc_id", "ids")
        out = [r["doc_id"] for r in found.collect()]
        leaf = found._jdf.queryExecution().executedPlan().collectLeaves().head()
        return out, leaf.metrics().apply("numOutputRows").value()

    out, n = read([123_450])
    assert out == [123_450] and 0 < n <= M.ROW_INDEX  # one row group of 40
    between = [k * 90_000 + 5 for k in range(4)]  # inside the ranges, but no document's
    out, n = read(between)
    assert out == [] and n <= M.ROW_INDEX  # the Bloom filters clear the other groups

    orc = spark._jvm.org.apache.orc.OrcFile
    from pathlib import Path
    file = sorted(Path(path).glob("part-*.orc"))[0]
    reader = orc.createReader(spark._jvm.org.apache.hadoop.fs.Path(str(file)),
                              orc.readerOptions(spark._jsc.hadoopConfiguration()))
    assert reader.getRowIndexStride() == M.ROW_INDEX and reader.getStripes().size() >= 1
    encodings = reader.getStripes().get(0)
    assert encodings.getIndexLength() > 0
    reader.close()
