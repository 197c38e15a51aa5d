import hashlib
import random

import pytest

from phenoscope.llm import mixing as X


def _fill(budget, children):
    """Slow water filling: (cap, weight) → shares."""
    got, open_ = [0.0] * len(children), [i for i, (c, w) in enumerate(children) if c > 0 and w > 0]
    while open_ and budget > 1e-9:
        total = sum(children[i][1] for i in open_)
        full = [i for i in open_ if children[i][0] <= budget * children[i][1] / total + 1e-9]
        if not full:
            for i in open_:
                got[i] = budget * children[i][1] / total
            break
        for i in full:
            got[i] = children[i][0]
        budget -= sum(children[i][0] for i in full)
        open_ = [i for i in open_ if i not in full]
    return got


def _brute(docs, weights, budget, epochs, seed=X.SEED):
    leaves = {}
    for d, dom, lang, src, n in docs:
        leaves.setdefault((dom, lang, src), []).append((d, n))
    w = lambda level, v: weights.get(level, {}).get(v, 1.0)

    def cap(leaf):
        ok = all(w(k, v) > 0 for k, v in zip(X.LEVELS, leaf))
        return sum(n for _, n in leaves[leaf]) * epochs if ok else 0

    share = {(): min(budget, sum(map(cap, leaves)))}
    for depth, level in enumerate(X.LEVELS):
        nodes = {}
        for leaf in leaves:
            nodes[leaf[:depth + 1]] = nodes.get(leaf[:depth + 1], 0) + cap(leaf)
        for parent in {k[:depth] for k in nodes}:
            kids = [k for k in nodes if k[:depth] == parent]
            for k, got in zip(kids, _fill(share[parent], [(nodes[k], w(level, k[-1])) for k in kids])):
                share[k] = got
    out = []
    for leaf, own in leaves.items():
        total, give = sum(n for _, n in own), int(share[leaf] + 1e-6)
        full, rest = divmod(give, total) if total else (0, 0)
        order = sorted((int(hashlib.md5(f"{seed}:{full + 1}:{d}".encode()).hexdigest()[:15], 16), d, n)
                       for d, n in own)
        out += [(d, e) for d, _ in own for e in range(1, full + 1)]
        run = 0
        for _, d, n in order:
            run += n
            if rest and run <= rest:
                out.append((d, full + 1))
    return sorted(out)


def _docs(n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for d in range(n):
        src = "src0" if rng.random() < 0.4 else f"src{rng.randrange(12)}"
        rows.append((d, f"d{int(src[3:]) % 4}", rng.choice(["en", "de", "fr"]), src, rng.choice([0, 1, 3, 40, 200])))
    return rows


def _frame(spark, rows):
    return spark.createDataFrame([(d, " ".join(["t"] * n), lang, src, 1) for d, _, lang, src, n in rows],
                                 "doc_id long, text string, lang string, source string, epoch int")


@pytest.mark.parametrize("share,weights", [
    (1.0, X.WEIGHTS), (0.3, {"domain": {"d1": 0.0}, "source": {"src2": 9.0}}), (5.0, X.WEIGHTS), (0.0, {})])
def test_equals_brute_force(spark, share, weights):
    rows = _docs()
    budget = int(sum(r[4] for r in rows) * share)
    got = X.mix(_frame(spark, rows), weights, budget, max_epochs=3).collect()
    assert sorted((r["doc_id"], r["epoch"]) for r in got) == _brute(rows, weights, budget, 3)


def test_one_leaf_refined(spark, monkeypatch):
    rows = [(d, "d0", "en", "src0", 1 + d % 7) for d in range(3000)]
    got = X.mix(_frame(spark, rows), {}, 5000, max_epochs=2).collect()
    assert sorted((r["doc_id"], r["epoch"]) for r in got) == _brute(rows, {}, 5000, 2)


def test_edge_cases(spark):
    df = spark.createDataFrame(
        [(1, None, "en", "src1"), (2, "", None, None), (3, "a b c", "en", "src1"), (3, "a b c", "en", "src1"),
         (None, "x y", None, "src1"), (4, "one two", "en", "odd")],
        "doc_id long, text string, lang string, source string")
    got = X.mix(df, {}).collect()
    assert sum(r["tokens"] for r in got) <= 10 and len(got) > 0
    assert {r["tokens"] for r in got if r["doc_id"] in (1, 2)} <= {0}
    assert len([r for r in got if r["doc_id"] == 3]) % 2 == 0
    assert X.mix(df.limit(0), {}).count() == 0
    with pytest.raises(ValueError):
        X.mix(df, {"lang": {"en": -1.0}})
