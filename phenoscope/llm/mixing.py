"""Mixing sources to target weights: hierarchical budgeting.

The token budget goes down a tree (domain, language, source) by weight.  A child
whose whole subtree cannot use its share gets what it can use (its tokens times the
epochs allowed) and the shortage is shared by weight among its siblings; only what a
whole subtree cannot use reaches the siblings of an ancestor.  That is the water
level of each sibling group: with children in the order of capacity over weight,
the level is the largest (budget - capacities before) / (weights from here on).

Each leaf reads seeded epochs: epoch e is the leaf's documents in the order of
md5(seed:e:id).  Whole epochs first, then the longest prefix of the next one within
the rest of the budget.  The prefix ends at one cut-off per leaf.  It is found by
sums over key ranges, twice, and then by a running sum within the one range that
holds it, so no leaf is ever sorted as a whole and a leaf may hold any share of
the rows; the documents are joined with leaf totals only.

A null text has no tokens; nulls in a tree column are a branch of their own. Missing
weights are 1, and a branch of weight 0 gets nothing.  Documents without tokens come
along with every whole epoch.  Rows that repeat an id and its text are taken together.
An empty table gives an empty result; input columns with the names of result
columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import broadcast_if_small
from .common import read_table, without, written

LEVELS = ("domain", "lang", "source")
#: Bits of the order key, and of the key ranges of each refinement.
KEY_BITS = 60
RANGE_BITS = 10
#: What the registered query and the pipeline use.
SEED = 7
MAX_EPOCHS = 2
WEIGHTS = {"domain": {"d0": 4.0, "d1": 3.0, "d2": 2.0, "d3": 1.0},
           "lang": {"en": 5.0, "de": 2.0, "fr": 2.0, "es": 1.0}}


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")


def domain_of(source: Column) -> Column:
    """Stand-in for a domain: the source's number modulo 4; null without a number."""
    return F.concat(F.lit("d"), (F.regexp_extract(source, "([0-9]+)$", 1).try_cast("int") % 4).cast("string"))


def _weight(level: str, weights: dict) -> Column:
    given = weights.get(level, {})
    if any(w < 0 for w in given.values()):
        raise ValueError(f"negative weight: {given}")
    out = F.lit(1.0)
    for name, w in given.items():
        out = F.when(F.col(level).cast("string") == F.lit(name), F.lit(float(w))).otherwise(out)
    return out


def allocate(leaves: DataFrame, budget: float, weights: dict, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``leaves(domain, lang, source, tokens)`` with ``budget`` (whole tokens)."""
    cap = leaves.withColumns({f"w_{c}": _weight(c, weights) for c in LEVELS})
    cap = cap.withColumn("cap", F.when(F.least(*[F.col(f"w_{c}") for c in LEVELS]) > 0,
                                       F.col("tokens") * F.lit(float(max_epochs))).otherwise(0.0))
    total = cap.agg(F.sum("cap")).first()[0] or 0.0
    out = cap.withColumn("got", F.lit(float(min(budget, total))))
    for depth, level in enumerate(LEVELS):
        parent, node = list(LEVELS[:depth]), list(LEVELS[:depth + 1])
        children = out.groupBy(*node).agg(F.sum("cap").alias("c"), F.first(f"w_{level}").alias("w"),
                                          F.first("got").alias("b")).where("c > 0")
        group = [F.col(p) for p in parent] or [F.lit(0)]
        order = Window.partitionBy(*group).orderBy(F.col("c") / F.col("w"), F.col(level))
        before = F.coalesce(F.sum("c").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        rest = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
        children = children.withColumn("level", (F.col("b") - before) / rest)
        water = F.max("level").over(Window.partitionBy(*group))
        children = children.withColumn(
            "share", F.greatest(F.lit(0.0), F.least("c", F.col("w") * water))).select(
            *[F.col(n).alias(f"n_{n}") for n in node], "share")
        on = [F.col(n).eqNullSafe(F.col(f"n_{n}")) for n in node]
        out = (out.join(children, on, "left").withColumn("got", F.coalesce("share", F.lit(0.0)))
               .drop("share", *[f"n_{n}" for n in node]))
    return out.select(*LEVELS, "tokens", F.floor(F.col("got") + 1e-6).cast("long").alias("budget"))


def _cut_offs(rows: DataFrame) -> DataFrame:
    """``rows(leaf, rest, key, id, row, tokens)`` → ``(leaf, cut)``: the last place
    of each leaf's order up to which the tokens sum to ``rest`` at most."""
    place = F.struct("key", F.col("id").isNull().alias("none"), "id", "row")
    cuts, now, at = None, rows.withColumn("before", F.lit(0).cast("long")), KEY_BITS
    keys = ["leaf", "rest"]
    for _ in range(2):
        at -= RANGE_BITS
        piece = F.shiftright(F.col("key"), at)
        sums = now.withColumn("piece", piece).groupBy(*keys, "before", "piece").agg(
            F.sum("tokens").alias("n"), F.max(place).alias("last"))
        order = Window.partitionBy(*keys).orderBy("piece")
        sums = sums.withColumn("after", F.col("before") + F.sum("n").over(order)).withColumn(
            "start", F.col("after") - F.col("n"))
        whole = sums.where("after <= rest").groupBy("leaf").agg(F.max("last").alias("cut"))
        cuts = whole if cuts is None else cuts.unionByName(whole)
        split = sums.where("start <= rest and after > rest").select(
            F.col("leaf").alias("l"), F.col("piece").alias("p"), "start")
        now = (now.drop("before").withColumn("piece", piece)
               .join(split, (F.col("leaf") == F.col("l")) & (F.col("piece") == F.col("p")))
               .withColumnRenamed("start", "before").drop("l", "p", "piece"))
    order = Window.partitionBy("leaf").orderBy("key", "none", "id", "row")  # ties count together
    last = (now.withColumn("none", F.col("id").isNull())
            .withColumn("sum", F.col("before") + F.sum("tokens").over(order))
            .where("sum <= rest").groupBy("leaf").agg(F.max(place).alias("cut")))
    return cuts.unionByName(last).groupBy("leaf").agg(F.max("cut").alias("cut"))


def mix(docs: DataFrame, weights: dict = WEIGHTS, budget: float | None = None, seed: int = SEED,
        max_epochs: int = MAX_EPOCHS, doc_id: str = "doc_id", text: str = "text",
        domain: Column | None = None, lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per document and epoch that takes it: ``docs`` with ``domain``,
    ``tokens`` and ``epoch``.  ``budget``: tokens in all (None: as many as there are)."""
    domain = domain_of(F.col(source)) if domain is None else domain
    kept = without(docs.withColumn("_phx_domain", domain), "domain", "tokens", "epoch")
    narrow = written(docs.select(
        F.col(doc_id).alias("id"), F.xxhash64(text).alias("row"), domain.alias("domain"),
        F.col(lang).alias("lang"), F.col(source).alias("source"),
        token_count(F.col(text)).alias("tokens")), "tokens")
    leaves = narrow.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    if budget is None:
        budget = float(narrow.agg(F.sum("tokens")).first()[0] or 0)
    plan = allocate(leaves, budget, weights, max_epochs)
    plan = written(plan.withColumns({
        "leaf": F.to_json(F.struct(*LEVELS)),
        "full": F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0)
    }).withColumn("rest", F.col("budget") - F.col("full") * F.col("tokens")), "plan")

    def key(of: str) -> Column:
        text_key = F.concat_ws(":", F.lit(str(seed)), (F.col("full") + 1).cast("string"),
                               F.col(of).cast("string"))
        return F.conv(F.substring(F.md5(text_key.cast("binary")), 1, 15), 16, 10).cast("long")

    leaf = F.to_json(F.struct(*LEVELS))
    small = plan.where("rest > 0").select("leaf", "full", "rest")
    places = (narrow.withColumn("leaf", leaf).join(broadcast_if_small(small), "leaf")
              .select("leaf", "rest", key("id").alias("key"), "id", "row", "tokens"))
    cuts = _cut_offs(places)
    per_leaf = broadcast_if_small(written(
        plan.join(cuts, "leaf", "left").select(F.col("leaf").alias("_phx_leaf"), "full", "cut")
        .where("full > 0 or cut is not null"), "cuts").select(
        "_phx_leaf", F.col("full").alias("_phx_full"), F.col("cut").alias("_phx_cut")))
    own_leaf = F.to_json(F.struct(F.col("_phx_domain").alias("domain"), F.col(lang).alias("lang"),
                                  F.col(source).alias("source")))
    joined = kept.join(per_leaf, own_leaf == F.col("_phx_leaf")).withColumn("full", F.col("_phx_full"))
    place = F.struct(key(doc_id).alias("key"), F.col(doc_id).isNull().alias("none"),
                     F.col(doc_id).alias("id"), F.xxhash64(text).alias("row"))
    times = F.col("_phx_full") + F.when(place <= F.col("_phx_cut"), 1).otherwise(0)
    taken = joined.withColumn("_phx_times", times.cast("int")).where("_phx_times > 0")
    return taken.select(
        *[F.col(f"`{c}`") for c in kept.columns if c != "_phx_domain"],
        F.col("_phx_domain").alias("domain"), token_count(F.col(text)).alias("tokens"),
        F.explode(F.sequence(F.lit(1), F.col("_phx_times"))).alias("epoch"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mix(read_table(spark, sf_dir, "documents"))
            .select("doc_id", "domain", "lang", "source", "tokens", "epoch"))


def _weight_sql(level: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in WEIGHTS.get(level, {}).items())
    return f"(CASE {level} {cases} ELSE 1.0 END)::DOUBLE" if cases else "1.0::DOUBLE"


def _level_sql(depth: int) -> str:
    level, parents, node = LEVELS[depth], LEVELS[:depth], LEVELS[:depth + 1]
    on = " AND ".join(f"p.{c} = o.{c}" for c in parents) or "true"
    by = f"PARTITION BY {', '.join(parents)}" if parents else ""
    source = f"s{depth - 1}" if depth else "(SELECT least((SELECT sum(tokens) FROM t), sum(cap)) AS share FROM cap)"
    return f"""
    c{depth} AS (SELECT {', '.join('o.' + c for c in node)}, sum(cap) AS c, any_value(w_{level}) AS w,
                        any_value(share) AS b
                 FROM cap o JOIN {source} p ON {on} GROUP BY ALL),
    l{depth} AS (SELECT *, (b - coalesce(sum(c) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                        / sum(w) OVER (q ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
                 FROM c{depth} WINDOW q AS ({by} ORDER BY c / w, {level})),
    s{depth} AS (SELECT {', '.join(node)},
                        greatest(0, least(c, w * max(level) OVER ({by}))) AS share FROM l{depth})"""


OP8_SQL = f"""
WITH t AS (SELECT doc_id, 'd' || (try_cast(regexp_extract(source, '([0-9]+)$', 1) AS INT) % 4) AS domain, lang, source,
                  len(regexp_extract_all(text, '[^ \\t-\\r]+')) AS tokens FROM documents),
    leaf AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS n FROM t GROUP BY ALL),
    cap AS (SELECT *, n * {MAX_EPOCHS}::DOUBLE AS cap, {_weight_sql('domain')} AS w_domain,
                   {_weight_sql('lang')} AS w_lang, {_weight_sql('source')} AS w_source FROM leaf),
    {','.join(_level_sql(d) for d in range(3))},
    b AS (SELECT l.*, floor(share + 1e-6)::BIGINT AS budget FROM leaf l JOIN s2 USING (domain, lang, source)),
    p AS (SELECT *, budget // n AS full_epochs, budget % n AS rest FROM b),
    k AS (SELECT t.*, full_epochs, rest,
                 ('0x' || md5('{SEED}:' || (full_epochs + 1) || ':' || doc_id)[1:15])::BIGINT AS key
          FROM t JOIN p USING (domain, lang, source)),
    x AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY key, doc_id) <= rest
                    AND rest > 0 AS more FROM k)
SELECT doc_id, domain, lang, source, tokens, unnest(range(1, full_epochs + more::INT + 1))::INT AS epoch
FROM x
"""
