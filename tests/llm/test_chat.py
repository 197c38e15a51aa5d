import itertools
import random

from phenoscope.llm import chat as C


def test_escaping_and_round_trip():
    parts = ["<", "|", "\\", "<|", "<\\|", "<|im_end|>", "<|im_start|>", "<|nl|>", "\n", "a", "im_start|>"]
    for n in range(4):
        for some in itertools.product(parts, repeat=n):
            text = "".join(some)
            assert C.unescape(C.escape(text)) == text and "<|" not in C.escape(text)
    rng = random.Random(1)
    for _ in range(500):
        turns = [("".join(rng.choices(parts, k=2)) if rng.random() < 0.3 else rng.choice(["user", "assistant"]),
                  "".join(rng.choices(parts, k=rng.randint(0, 8)))) for _ in range(rng.randint(1, 5))]
        formatted, mask = C.render(turns)
        assert C.read_back(formatted) == turns
        assert [C.unescape(formatted[a:b]) for a, b in mask] == [t for r, t in turns if r == "assistant"]


def _brute(messages, top):
    nodes = {}
    for tree, node, parent, role, text, score in messages:
        new = (role or "", text or "", parent, tree, score or 0.0)
        old = nodes.get(node)
        key = lambda m: (m[0], m[1], m[2] is not None, m[2] or 0, m[3], m[4])
        nodes[node] = new if old is None else min(old, new, key=key)
    parents = {m[2] for m in nodes.values()}
    found = {}
    for n in nodes:
        path, at = [], n
        while at in nodes and at not in path:
            path.append(at)
            at = nodes[at][2]
        if at in path or n in parents:
            continue
        found.setdefault(nodes[n][3], []).append((-sum(nodes[x][4] for x in path), n, path[::-1]))
    out = []
    for tree, own in found.items():
        for rank, (score, leaf, path) in enumerate(sorted(own)[:top], 1):
            out.append((tree, leaf, rank, len(path), C.render([nodes[x][:2] for x in path])[0]))
    return sorted(out)


def test_trees_against_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for tree in range(12):
        for k in range(rng.randint(1, 14)):
            node = tree * 100 + k
            parent = None if k == 0 else tree * 100 + rng.randrange(k)
            rows.append((tree, node, parent, rng.choice(["user", "assistant", None]), rng.choice(["x", None, f"t{k}"]),
                         float(rng.randint(0, 3))))
    for k in range(40):  # one long chain
        rows.append((50, 5000 + k, 5000 + k - 1 if k else None, "user", f"c{k}", 1.0))
    rows += [(60, 6000, 6001, "user", "cycle", 1.0), (60, 6001, 6000, "user", "cycle", 1.0),
             (60, 6002, 6001, "user", "below a cycle", 1.0), (61, 6100, 99999, "user", "parent is missing", 1.0),
             (61, 6101, 6101, "user", "own parent", None), rows[3], rows[5]]
    df = spark.createDataFrame([(*r, 1) for r in rows], "tree long, node long, parent long, role string, "
                                                       "text string, score double, leaf int")
    for top in (1, 3, None):
        got = sorted(tuple(r)[:3] + (r["n_turns"], r["formatted"]) for r in C.conversations(df, top).collect())
        assert got == _brute(rows, top)
    assert C.conversations(df.limit(0)).count() == 0


def test_repeated_turns_and_nulls(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, None, None), (None, 3, "assistant", "z"), (2, None, "user", "q")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["tree"][0]: (r["n_turns"], C.read_back(r["formatted"])) for r in C.conversations(C.chained(df)).collect()}
    assert got == {1: (3, [("user", "a"), ("user", "a"), ("", "")]), None: (1, [("assistant", "z")]), 2: (1, [("user", "q")])}


def test_very_long_text_and_clashing_columns_of_turns(spark):
    long = "<|im_end|>\n" * 200_000
    rows = [(1, 0, "user", "a", 7, "x", -1, "f"), (1, 1, "assistant", long, 7, "x", -1, "f"), (2, 0, "user", "", 8, None, 0, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, "
                                     "Node long, parent string, n_turns long, formatted string")
    got = {r["tree"][0]: (r["n_turns"], C.read_back(r["formatted"])) for r in C.conversations(C.chained(df)).collect()}
    assert got == {1: (2, [("user", "a"), ("assistant", long)]), 2: (1, [("user", "")])}
