import itertools
import random
import re
from collections import Counter, defaultdict

from phenoscope.llm import filter_audit as M


def _plain_mask(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return ((len(words) < 50) | (100 * len(set(words)) < 65 * len(words)) << 1
            | (100 * len(re.findall("[A-Z]", text)) > 5 * len(text)) << 2 | bool(re.search(r"[#$%&*|]", text)) << 3)


def _brute(docs, labels):
    """Every order applied one document at a time."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    masks = defaultdict(list)
    for i, text, source in docs:
        ids = [j for j, other, _ in docs if (other or "") == (text or "") and j is not None]
        again = bool(ids) and (i is None or min(ids) < i)
        masks[source or ""].append((i, _plain_mask(text or "") | again << 4))
    out = set()
    for part, rows in masks.items():
        removed, steps = Counter(), {}
        for order in itertools.permutations("ABCDE"):
            left = list(rows)
            for k, f in enumerate(order):
                bit = 1 << "ABCDE".index(f)
                here = [i for i, m in left if m & bit]
                left = [(i, m) for i, m in left if not m & bit]
                removed[f] += len(here)
                steps["".join(order), k + 1] = (
                    len(left), len(here), sum(1 for _, m in rows if m & bit) - len(here),
                    sum(1 for _, m in rows if m == bit), sum(i in good for i in here), sum(i in toxic for i in here), f)
        out |= {(part, o, k, *v[:-1], removed[v[-1]]) for (o, k), v in steps.items()}
    return out


def _run(spark, docs, labels):
    d = spark.createDataFrame([(*r, 7, "x", 1) for r in docs],
                              "doc_id long, text string, source string, h int, mask string, n int")
    lab = spark.createDataFrame([(*r, 0) for r in labels], "doc_id long, quality int, toxic int, good int")
    out = M.order_effects(M.failure_counts(d, lab))
    assert out.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                           "good_lost", "toxic_lost", "shapley"]
    return {tuple(r) for r in out.collect()}


def _cases():
    rng = random.Random(2)
    words = [f"w{k}" for k in range(90)]
    texts = [None, "", " \t\r\n", "A", "É" * 60, "one two", "x\x85y z", "a|b",
             *[" ".join(rng.choices(words, k=rng.randint(40, 90))) + rng.choice(["", " #", " ABCDEFGHIJ KLMNOPQ"])
               for _ in range(40)], "Long " * 60_000]
    docs = [(i, rng.choice(texts), rng.choice(["a", "b", None, ""])) for i in range(150)]
    docs += [(None, "one two", "a"), (None, "one two", "a"), (None, "nobody has this", "b"),
             (3, docs[3][1], "a"), (3, docs[3][1], "a"), (-5, "a|b", "é")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)]
    return docs, labels + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (9999, 1, 1)]


def test_every_order_equals_brute_force(spark):
    docs, labels = _cases()
    assert _run(spark, docs, labels) == _brute(docs, labels)


def test_a_full_bloom_filter_changes_nothing(spark, monkeypatch):
    """All texts in one block of counters, and suspects that are not broadcast."""
    docs, labels = _cases()
    plain = M._counters
    monkeypatch.setattr(M, "_counters", lambda h, blocks: plain(h, 1))
    monkeypatch.setattr(M, "SUSPECTS", 0)
    assert _run(spark, docs, labels) == _brute(docs, labels)


def test_only_possible_repeats_pass_the_filter(spark):
    n = 4000
    hashes = spark.range(n).select(M.F.xxhash64(M.F.col("id") % (n - 100)).alias("h"))
    block, bits = M._counters(M.F.col("h"), n)
    suspects = M.possible_repeats(hashes, n)
    left = (hashes.select("h", block.alias("block"), bits.alias("bits")).join(suspects, "block")
            .where(M.F.col("bits").bitwiseAND(M.F.col("twice")) == M.F.col("bits")))
    counted = Counter(r["h"] for r in left.select("h").collect())
    assert sum(1 for c in counted.values() if c == 2) == 100  # no repeat is cleared
    assert len(counted) <= 110  # and hardly a unique text is kept


def test_empty_table(spark):
    assert _run(spark, [], [(1, 1, 1)]) == set()


def test_words_in_pieces(monkeypatch):
    data = ("alpha beta\tgamma alpha\n" * 50 + "x" * 40 + " end").encode()
    whole = M.words_of(data)
    monkeypatch.setattr(M, "PIECE", 7)
    assert M.words_of(data) == whole == (202, 5)
