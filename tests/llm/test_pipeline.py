import duckdb

import corpus_pipeline as P
from phenoscope.llm.common import read_table, written
from phenoscope.llm.mixing import OP8_SQL

from test_decontam import _brute as _contained
from test_lines import _brute as _left_lines
from test_simhash import _plain, _roots

SF = "/root/testdata/sf0.001"


def test_run_and_stage_columns(spark):
    docs = read_table(spark, SF, "documents")
    columns = docs.columns
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
    out = P.run(spark, SF)
    assert set(columns) <= set(out.columns) and out.count() > 0
    assert {r["doc_id"] for r in out.select("doc_id").collect()} <= \
        {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_odd_rows_and_clashing_columns(spark):
    rows = [(1, None, "en", "src1", 0, 0.5, 1), (2, "", None, "src1", 0, 0.5, 1), (3, "12 34", "en", None, 5, None, 1),
            (None, "the cat sat on the mat again", "en", "src2", 28, 0.1, 2),
            (4, "the cat sat on the mat again", "en", "src2", 28, 0.1, 2),
            (4, "the cat sat on the mat again", "en", "src2", 28, 0.1, 2),
            (5, "der hund lief\nüber die\nstraße", "de", "src3", 30, 0.1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                       "n_chars long, score double, n_lines int")
    first = P.language_id(spark, docs, SF)
    assert sorted(r["doc_id"] or 0 for r in first.collect()) == [0, 4, 4, 5]
    for df in (docs, docs.limit(0)):
        for name, stage in P.STAGES:
            df = stage(spark, df, SF)
            if name != "source_mixing":
                assert df.columns == docs.columns
        ids = [r["doc_id"] for r in df.collect()]
        assert set(ids) <= {4, 5}


def test_every_stage_against_brute_force_on_its_own_input(spark):
    docs = read_table(spark, SF, "documents")
    stages = dict(P.STAGES)

    def rows(df):
        return {r["doc_id"]: r.asDict() for r in df.collect()}

    def following(name):
        return written(stages[name](spark, docs, SF), f"test-{name}")

    # language ID: only texts without a language of at least half go, only null langs change
    before, docs = rows(docs), following("language_id")
    after = rows(docs)
    assert all(any(c.isalpha() for c in r["text"]) for r in after.values())
    assert all(r == {**before[i], "lang": r["lang"]} for i, r in after.items())
    assert all(r["lang"] == (before[i]["lang"] or r["lang"]) and r["lang"] for i, r in after.items())
    lost = [r["text"] for i, r in before.items() if i not in after]
    assert len(lost) <= 0.01 * len(before)
    # line dedup
    before, docs = after, following("line_dedup")
    after = rows(docs)
    want = {i: t for i, t, _, _ in _left_lines([(i, before[i]["text"]) for i in sorted(before)])}
    assert {i: r["text"] for i, r in after.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())
    assert any(want[i] != before[i]["text"] for i in want)
    # near-duplicates: the smallest id of each component stays, unchanged
    before, docs = after, following("simhash_near_dedup")
    after = rows(docs)
    fp = {i: _plain(r["text"]) for i, r in before.items()}
    ids = sorted(fp)
    root = _roots(ids, [(a, b) for n, a in enumerate(ids) for b in ids[:n] if (fp[a] ^ fp[b]).bit_count() <= 4])
    assert after == {i: before[i] for i in ids if root[i] == i} and len(after) < len(before)
    # benchmark items inside documents
    items = [(r["item_id"], r["text"]) for r in read_table(spark, SF, "benchmark").collect()]
    before, docs = after, following("benchmark_decontamination")
    after = rows(docs)
    hit = {d for d, *_ in _contained([(i, r["text"]) for i, r in before.items()], items)}
    assert after == {i: r for i, r in before.items() if i not in hit} and hit
    # mixing, by the operator's SQL over this stage's input
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    columns = ["doc_id", "domain", "lang", "source", "tokens", "epoch"]
    want = con.sql(OP8_SQL).select(*columns).fetchall()
    assert sorted(map(tuple, following("source_mixing").select(*columns).collect())) == sorted(want) and want
