"""Personal data by candidate gradient boosting, in DataFrame functions only.

Base patterns with checks (address parts, Luhn sum, digit counts) give spans that are
always redacted.  High-recall generators propose further, overlapping spans: whatever
fails a base check, loose digit groups, spelled-out mail addresses, long keys,
colon-separated addresses.  Boosted trees score every candidate by its format and its
context.  A candidate is an example of personal data if it overlaps a checked span or if
there is evidence for its kind: a key of which an eighth are digits assigned to a name
such as token, a mail address whose at and dot are spelled out, a number right behind a
word for telephone, a whole address of eight (or six two-digit) groups, a card number
behind its word with a right sum.  The trees see no values, and of a kind's own evidence
neither the words before it nor the spelled-out parts: they learn what the examples look
like elsewhere, so a key without such a word is found by its format.

Words before a key or a telephone number mark only some of them, so a score is right in as
many cases as are marked, divided by the score that marked ones get on average (not below
``LEAST_MARKED``), give or take that average's standard error.  Per kind, the threshold is the lowest score from which ``PRECISION``
of the candidates that the trees did not learn from are right in this sense; ``PRIOR``
candidates of the average of all kinds are added to the count, so that few candidates
lean on the others.  Where all candidates are of one class, evidence decides.

Positions come from two scans of a pattern, the matches and the pieces between them, and
prefix sums of their lengths in two levels, so a text with many matches costs no
repeated scan.  Patterns use possessive runs that begin where a run begins: no
backtracking grows with the length of a run.  Only candidates leave the scan; the model
is fitted on at most about ``SAMPLE`` of them, an equal part of each kind, and applied to all.

A null text counts as empty.  Rows that repeat an id and its text get equal results;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import functools
import math

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from .common import any_of, read_table, same, written

# fixed values: the base patterns, anchored where a run of their characters begins
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# fixed values: the loose generators, in one alternation
_KEY = "[A-Za-z0-9_/+=-]"
LOOSE = "|".join((
    # before the digits, so that a key that begins with many digits stays whole
    rf"(?<!{_KEY})(?=[0-9_/+=-]*+[A-Za-z])(?=[A-Za-z_/+=-]*+[0-9]){_KEY}{{20,}}+(?!\x20?[(\[]at[)\]])",
    r"(?<![0-9])\+?\(?[0-9](?:[\x20()./-]{0,2}+[0-9]){6,}+",
    rf"(?<!{_LOCAL}){_LOCAL}++\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?{_LABEL}++\x20?"
    r"(?:\.|\(dot\)|\[dot\]|\x20dot\x20)\x20?[A-Za-z]{2,}+",
    r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}+[0-9A-Fa-f]{1,4}",
    rf"(?<!{_KEY})(?=[A-Za-z_/+=-]*+[0-9]){_KEY}{{20,}}+",
))
KINDS = ["email", "ip", "card", "phone", "secret"]
# fixed values: words before a span that hint at its kind
HINTS = {"mail": "mail|contact", "phone": "phone|tel|call|fax|mobil", "card": "card|visa|credit|karte|iban",
         "net": r"\bip\b|addr|host|server", "key": "token|key|secret|passw|api"}
#: The kind whose evidence the words are part of; its candidates do not show them.
OWN = {"mail": "email", "phone": "phone", "card": "card", "net": "ip", "key": "secret"}
# fixed values: evidence right before a span, in small letters, that it is of its kind
LABELS = {
    "phone": r"(?:^|[^a-z])(?:tele)?(?:phone|tel|call|fax|mobile?|cell|handy)[^a-z0-9]{0,6}$",
    "secret": r"(?:token|key|secret|passw(?:or)?d|pwd|auth|bearer|credentials?)[\"']?\s*(?:=>|[:=]|\s)\s*[\"']?$",
    "ip": r"(?:^|[^a-z])(?:ip|ipv6|addr(?:ess)?|host|server|mac)[^a-z0-9]{0,4}$",
    "card": r"(?:^|[^a-z])(?:card|visa|mastercard|credit|karte)(?:\s+(?:no|number|nr))?[^a-z0-9]{0,6}$",
}
CONTEXT = 24
#: Rows, about, that the trees learn from.
SAMPLE = 20_000
PRECISION = 0.99
PRIOR = 5
PARTLY_MARKED = {"secret", "phone"}
LEAST_MARKED = 0.3
MOST_DOUBT = 0.15
TREES, DEPTH, LEAF, SEED = 10, 4, 8, 9
_STEP = 256


def _located(df: DataFrame, pattern: str, name: str) -> DataFrame:
    """``df(text)`` with the matches of ``pattern`` as structs in column ``name``."""
    m, p, n = f"{name}_m", f"{name}_p", f"{name}_n"
    df = df.withColumn(m, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    df = df.withColumn(p, F.when(F.size(m) > 0, F.split("text", pattern, -1)))
    # what a match adds to the place of the next: the piece before it and the last match
    df = df.withColumn(n, F.transform(m, lambda x, i: F.length(F.get(F.col(p), i)) + F.when(
        i > 0, F.length(F.get(F.col(m), i - 1))).otherwise(0)))
    zero, add = F.lit(0), (lambda s, x: s + x)
    many = f"{name}_s"  # sums of whole steps
    df = df.withColumn(many, F.when(F.size(n) > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(n) - 1) / _STEP).cast("int")),
        lambda c: F.aggregate(F.slice(F.col(n), c * _STEP + 1, F.lit(_STEP)), zero, add))))
    df = df.withColumn(many, F.transform(many, lambda x, c: F.aggregate(
        F.slice(F.col(many), F.lit(1), c), zero, add)))

    def match(x: Column, i: Column) -> Column:
        step = F.floor(i / _STEP).cast("int")
        start = F.get(F.col(many), step) + F.aggregate(
            F.slice(F.col(n), step * _STEP + 1, i % _STEP + 1), zero, add)
        return F.struct(start.alias("start"), (start + F.length(x)).alias("end"), x.alias("value"),
                        F.right(F.get(F.col(p), i), F.lit(CONTEXT)).alias("before"),
                        F.left(F.get(F.col(p), i + 1), F.lit(CONTEXT)).alias("after"))

    return df.withColumn(name, F.transform(m, match)).drop(m, p, n, many)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the Luhn sum is a multiple of 10."""
    def value(i: Column) -> Column:  # i-th digit from the right, from 0
        d = F.substring(F.reverse(digits), i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda s, i: s + value(i)) % 10 == 0


def _checked(kind: str, value: Column) -> Column:
    """Whether a base match stands."""
    n = F.length(_digits(value))
    if kind == "ip":
        part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.when((n >= 12) & (n <= 19), _luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return (n >= 9) & (n <= 15)
    return F.lit(True)


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per proposed span: ``id, row, kind, start, end, value, before, after``,
    ``base`` (a checked base span), ``known`` (overlaps one) and ``inside`` (lies in one)."""
    df = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("row"),
                     F.coalesce(text, F.lit("")).alias("text"))
    for name, pattern in {**BASE, "loose": LOOSE}.items():
        df = _located(df, pattern, name)

    def typed(kind: str):
        return lambda x: F.struct(
            F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"),
            x["before"].alias("before"), x["after"].alias("after"), _checked(kind, x["value"]).alias("base"))

    def loose(x: Column) -> Column:
        v = x["value"]
        n = F.length(_digits(v))
        kind = (F.when(v.rlike(r"^[+(]?[0-9][0-9\x20()./-]*$"), F.when((n >= 12) & ~v.startswith("+"), "card")
                       .otherwise("phone"))
                .when(v.rlike(r"\(at\)|\[at\]|\x20at\x20"), "email")
                .when(v.contains(":"), "ip").otherwise("secret"))
        return F.struct(kind.alias("kind"), x["start"].alias("start"), x["end"].alias("end"), v.alias("value"),
                        x["before"].alias("before"), x["after"].alias("after"), F.lit(False).alias("base"))

    df = df.select("id", "row", F.concat(*[F.transform(k, typed(k)) for k in BASE], F.transform("loose", loose)).alias("all"))
    df = df.withColumn("sure", F.transform(
        F.filter("all", lambda x: x["base"]), lambda x: F.struct(x["start"], x["end"])))
    # explode_outer: a filter on the array would be pushed down and scan the text once more
    df = df.select("id", "row", F.explode_outer("all").alias("c"), "sure").where("c is not null").select(
        "id", "row", "c.*", "sure")
    near = F.exists("sure", lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start")))
    return df.withColumn("known", F.when(F.col("base"), True).otherwise(near)).withColumn(
        "inside", F.col("base") | F.exists("sure", lambda s: (s["start"] <= F.col("start")) & (s["end"] >= F.col("end")))
    ).drop("sure")


def _labelled(kind: str) -> Column:
    return F.lower("before").rlike(LABELS[kind])


def evidence() -> Column:
    """Whether a candidate is an example of personal data."""
    v, n = F.col("value"), F.length(_digits(F.col("value")))
    at, dot = r"\(at\)|\[at\]", r"\(dot\)|\[dot\]|\x20dot\x20"
    rules = {
        "email": v.rlike(at) | (v.rlike(r"\x20at\x20") & v.rlike(dot)),
        "ip": v.rlike("^(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$|^(?:[0-9A-Fa-f]{2}:){5}[0-9A-Fa-f]{2}$")
        | (v.contains(":") & _labelled("ip")),
        "card": F.when((n >= 12) & (n <= 19) & _labelled("card"), _luhn(_digits(v))).otherwise(False),
        "phone": (n >= 7) & (n <= 15) & _labelled("phone"),
        "secret": _labelled("secret") & (8 * n >= F.length(v)),
    }
    # digits in a key may pass for a card by chance
    checked = F.col("known") & ((F.col("kind") != "secret") | F.col("inside"))
    return F.coalesce(checked | any_of([(F.col("kind") == k) & r for k, r in rules.items()]), F.lit(False))


def with_features(found: DataFrame) -> tuple[DataFrame, list[str]]:
    """Format and context of each candidate as numbers; no value among them."""
    v, before, after = F.col("value"), F.lower("before"), F.col("after")
    count = lambda pattern: F.regexp_count(v, F.lit(pattern)).cast("double")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    features = {f"is_{k}": flag(F.col("kind") == k) for k in KINDS}
    features |= {
        "length": F.length(v).cast("double"), "digits": count("[0-9]"), "letters": count("[A-Za-z]"),
        "upper": count("[A-Z]"), "groups": count("[0-9]+"), "dots": count(r"\."), "blanks": count(r"\x20"),
        "dashes": count("-"), "brackets": count("[()]"), "plus": flag(v.startswith("+")), "at": flag(v.contains("@")),
        "colons": count(":"), "joined_left": flag(before.rlike("[a-z0-9]$")), "joined_right": flag(after.rlike("^[A-Za-z0-9]")),
        "assigned": flag((F.col("kind") != "secret") & before.rlike("[:=]\\s*[\"']?$")), "line_start": flag(before.rlike("(^|\n)$")),
        "line_end": flag(after.rlike("^($|\n)")),
    } | {f"says_{k}": flag((F.col("kind") != OWN[k]) & before.rlike(p)) for k, p in HINTS.items()}
    named = {f"f_{k}": c for k, c in features.items()}
    return found.withColumns(named), list(named)


def fit(found: DataFrame, sample: int = SAMPLE, precision: float = PRECISION
        ) -> tuple[GBTClassificationModel, dict[str, float]] | None:
    """Trees and a threshold per kind, from the candidates' checks and evidence; None if
    they are all of one class."""
    total = dict(map(tuple, found.groupBy("kind").count().collect()))
    slots = 1 << 20
    # an equal part of the sample for each kind, so that a rare one is learned too
    shares = {k: int(min(0.5, sample / len(KINDS) / n) * slots) for k, n in total.items()}
    share = functools.reduce(lambda c, k: c.when(F.col("kind") == k, shares[k]), shares, F.when(F.lit(False), 0))
    taken = F.pmod(F.xxhash64("id", "kind", "start", "end"), F.lit(slots)) < share
    rows, names = with_features(found)
    rows = rows.withColumn("label", evidence().cast("double"))
    learn = VectorAssembler(inputCols=names, outputCol="features").transform(
        rows.where(taken).select("label", *names)).select("label", "features")
    learn = reliable_checkpoint(learn.repartition(2, "label"))  # bounded, and read by every tree
    if learn.select("label").distinct().count() < 2:
        return None
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, minInstancesPerNode=LEAF, seed=SEED, labelCol="label").fit(learn)
    held = scored(rows.where(~taken), model, names)
    bins = (held.groupBy("kind", F.floor(F.col("p") * 200).cast("int").alias("bin"))
            .agg(F.count("*").alias("n"), F.sum("label").alias("right"),
                 F.sum(F.col("p") * F.col("label")).alias("score")).collect())
    return model, thresholds(bins, precision)


def thresholds(bins: list, precision: float) -> dict[str, float]:
    """``bins`` of scores, with ``kind``, ``bin``, ``n``, ``right`` and the ``score`` of the
    right ones → the least score of each kind that is right often enough."""
    limits = {}
    for kind in {r["kind"] for r in bins}:
        own = [r for r in bins if r["kind"] == kind]
        marked = sum(r["right"] for r in own)
        share = 1.0
        if marked and kind in PARTLY_MARKED:
            share = max(LEAST_MARKED, sum(r["score"] for r in own) / marked)
        for least in sorted({r["bin"] for r in own}, reverse=True):
            n, right = (sum(r[c] for r in own if r["bin"] >= least) for c in ("n", "right"))
            all_n, all_right = (sum(r[c] for r in bins if r["bin"] >= least) for c in ("n", "right"))
            # the evidence of the other kinds is their format: what has it not is none
            doubt = 0.0 if kind not in PARTLY_MARKED else min(MOST_DOUBT, math.sqrt((1 - min(share, 1.0)) / share / max(marked, 1)))
            if min(1.0, (right + PRIOR * all_right / all_n) / (n + PRIOR) / share + doubt) >= precision:
                limits[kind] = least / 200
    return limits



def scored(rows: DataFrame, model: GBTClassificationModel, names: list[str]) -> DataFrame:
    """``rows`` with ``p``, the probability of personal data."""
    ready = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    return model.transform(ready).withColumn("p", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction")


def select_redactions(found: DataFrame, sample: int = SAMPLE, precision: float = PRECISION) -> DataFrame:
    """``id, row, kind, start, end, base``: the base spans, and of the other candidates
    those at or over their kind's threshold that no base span touches, or keys that are
    more than the base spans in them."""
    base = found.where("base").select("id", "row", "kind", "start", "end", "base")
    open_ = found.where("not inside and (not known or kind = 'secret')")
    learned = fit(found, sample, precision)
    if learned is None:
        return base.unionByName(open_.where(evidence()).select(*base.columns)).distinct()
    model, limits = learned
    if not limits:
        return base
    rows, names = with_features(open_)
    over = any_of([(F.col("kind") == k) & (F.col("p") >= t) for k, t in limits.items()])
    return base.unionByName(scored(rows, model, names).where(over).select(*base.columns)).distinct()


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and ``spans``, structs ``(start, kind, end, base)``
    in the order of start, kind (as in ``KINDS``) and end."""
    found = written(candidates(docs, doc_id, text), "candidates")
    place = functools.reduce(lambda c, k: c.when(F.col("kind") == k[1], k[0]), enumerate(KINDS), F.when(F.lit(False), -1))
    span = F.struct("start", place.alias("place"), "end", "kind", "base")
    per_doc = (select_redactions(found).groupBy("id", "row").agg(F.sort_array(F.collect_set(span)).alias("spans"))
               .withColumnsRenamed({"id": "i", "row": "r"}))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("row"))
    joined = rows.join(per_doc, same(F.col("doc_id"), F.col("i")) & same(F.col("row"), F.col("r")), "left")
    empty = F.array().cast(per_doc.schema["spans"].dataType)
    return joined.select("doc_id", F.coalesce("spans", empty).alias("spans"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def told(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, BASE), F.sha2(told(base).cast("binary"), 256).alias("base_sha256"),
                        told(F.col("spans")).alias("spans"),
                        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"))
