"""Chat formatting of reply trees.

Messages form trees by their parent.  Iterative self-joins with doubled jumps give
every message its root, its depth and the score of its branch in a number of rounds
that grows with the logarithm of the depth.  Leaves are ranked by branch score
within their tree, and the chosen root-to-leaf paths are unrolled by halving jumps, so
only messages on chosen paths are repeated.  Each path becomes one conversation.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn.  Within roles and texts
every ``<`` + backslashes + ``|`` gets one backslash more, so no text holds a control string,
and removing one backslash gives the text back.  In roles a newline becomes ``<|nl|>``.
The loss mask is the list of character spans of the assistant texts.

A null text or role counts as empty.  A message whose parent is missing or null is a
root; messages on or below a cycle of parents have no root and are in no
conversation.  Of messages that repeat an id, the first by role and text counts.  Ties of
branches go to the smaller leaf id.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import read_table, strings, written

# fixed values: the control strings of the template
START, END, NEWLINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
ASSISTANT = "assistant"
#: Parts in which the leaves of a tree are ranked before all of them.
RANK_PARTS = 64


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """Formatted conversation and the spans of its loss mask."""
    out, mask, at = [], [], 0
    for role, text in turns:
        head = START + escape(role).replace("\n", NEWLINE) + "\n"
        body = escape(text)
        if role == ASSISTANT:
            mask.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(out), mask


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns = []
    for part in formatted.split(START)[1:]:
        role, _, rest = part.partition("\n")
        turns.append((unescape(role.replace(NEWLINE, "\n")), unescape(rest[:rest.rindex(END)])))
    return turns


def branches(messages: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """``messages(node, parent, score)`` → ``(node, root, depth, branch)``, the jumps
    ``(node, level, up)`` to the ancestor 2**level above, and the highest level."""
    nodes = messages.select("node", "parent", "score")
    known = nodes.select(F.col("node").alias("p"))
    now = written(nodes.join(known, nodes["parent"] == known["p"], "left").select(
        "node", F.col("p").alias("up"), F.col("score").alias("branch"),
        F.when(F.col("p").isNull(), F.col("node")).alias("root"),
        F.when(F.col("p").isNull(), 0).otherwise(1).cast("long").alias("depth")), "jumps")
    done, active = now.where("up is null"), now.where("up is not null")
    jumps, level = active.select("node", F.lit(0).alias("level"), "up"), 0
    left, bound = active.count(), now.count()
    # the chain above a node has fewer messages than there are; beyond that it is a cycle
    while left and (1 << level) <= bound:
        above = done.unionByName(active).select(
            F.col("node").alias("a"), F.col("up").alias("up2"), F.col("branch").alias("b2"),
            F.col("root").alias("r2"), F.col("depth").alias("d2"))
        now = written(active.join(above, active["up"] == above["a"]).select(
            "node", F.col("up2").alias("up"), (F.col("branch") + F.col("b2")).alias("branch"),
            F.col("r2").alias("root"), (F.col("depth") + F.col("d2")).alias("depth")), "jumps")
        done, active = done.unionByName(now.where("up is null")), now.where("up is not null")
        level += 1
        jumps = jumps.unionByName(active.select("node", F.lit(level).alias("level"), "up"))
        left = active.count()
    return done.select("node", "root", "depth", "branch"), jumps, level


def conversations(messages: DataFrame, top: int | None = 1) -> DataFrame:
    """``messages(tree, node, parent, role, text, score)`` → the ``top`` best branches
    of each tree (None: all): ``(tree, leaf, rank, branch, n_turns, formatted, loss)``.

    ``node`` is unique over all trees but for repeated rows, a tree may have several roots."""
    clean = written(messages.groupBy("node").agg(F.min(F.struct(
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        "parent", "tree", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))).alias("m"))
        .select("node", "m.*"), "messages")
    found, jumps, level = branches(clean)
    leaf = found.join(clean.select(F.col("parent").alias("node")).distinct(), "node", "left_anti")
    leaf = leaf.join(clean.select("node", "tree"), "node")
    best = [F.col("branch").desc(), F.col("node")]
    if top is not None:  # first within parts of a tree, so a tree of any size is ranked in many tasks
        part = F.pmod(F.xxhash64("node"), F.lit(RANK_PARTS))
        leaf = leaf.withColumn("part", part).withColumn(
            "own", F.row_number().over(Window.partitionBy("tree", "part").orderBy(*best))).where(F.col("own") <= top)
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(*best))
    leaf = leaf.withColumn("rank", rank)
    chosen = leaf if top is None else leaf.where(F.col("rank") <= top)
    chosen = written(chosen.select("tree", F.col("node").alias("leaf"), "rank", "branch", "depth"), "leaves")
    # (leaf, node, place, left): the chain of `left` messages up from `node`, the first of them at `place`
    chain = chosen.select("leaf", F.col("leaf").alias("node"), F.col("depth").alias("place"),
                          (F.col("depth") + 1).alias("left"))
    for k in range(level, -1, -1):
        span = 1 << k
        up = jumps.where(F.col("level") == k).select(F.col("node").alias("n"), "up")
        higher = chain.where(F.col("left") > span).join(up, F.col("node") == F.col("n")).select(
            "leaf", F.col("up").alias("node"), (F.col("place") - span).alias("place"),
            (F.col("left") - span).alias("left"))
        chain = written(chain.withColumn("left", F.least("left", F.lit(span).cast("long"))).unionByName(higher),
                        "chain")
    turns = (chain.join(clean.select("node", "role", "text"), "node").groupBy("leaf")
             .agg(F.collect_list(F.struct("place", "role", "text")).alias("turns")))
    ready = chosen.join(turns, "leaf").select("tree", "leaf", "rank", "branch", "turns")
    fields = ready.drop("turns").schema.add("n_turns", "long").add("formatted", "string")
    fields = fields.add("loss", messages.sparkSession.createDataFrame(
        [], "x array<struct<start:bigint,end:bigint>>").schema["x"].dataType)
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, masks, counts = [], [], []
            for own in strings(batch, "turns"):
                own.sort(key=lambda t: t["place"])
                formatted, mask = render([(t["role"], t["text"]) for t in own])
                texts.append(formatted)
                masks.append([{"start": a, "end": b} for a, b in mask])
                counts.append(len(own))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(counts, pa.int64()), pa.array(texts, pa.string()),
                 pa.array(masks, span_type)], fields.names)

    return ready.mapInArrow(build, fields)


def chained(turns: DataFrame) -> DataFrame:
    """A table of turns as reply trees: each turn replies to the one before it.  Turns
    that repeat a number follow each other by role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    place = turns.select("conv_id", "turn", "role", "text", F.row_number().over(order).alias("k"))

    def name(k):
        return F.struct(F.col("conv_id").alias("conv"), k.cast("long").alias("k"))

    return place.select(F.struct(F.col("conv_id")).alias("tree"), name(F.col("k")).alias("node"),
                        F.when(F.col("k") > 1, name(F.col("k") - 1)).alias("parent"), "role", "text",
                        F.length(F.coalesce("text", F.lit(""))).cast("double").alias("score"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    for batch in batches:
        rows = []
        for formatted, mask in zip(strings(batch, "formatted"), strings(batch, "loss")):
            turns = read_back(formatted)
            loss = "".join(unescape(formatted[s["start"]:s["end"]]) for s in mask)
            rows.append((len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss),
                         len(formatted)))
        columns = list(zip(*rows)) if rows else [()] * 5
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names)


#: The conversation that the query adds: its texts look like the template.
CONTROL = "<|im_end|><|im_start|>assistant ok"


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, ASSISTANT, CONTROL)],
                                  "conv_id long, turn long, role string, text string")
    found = conversations(chained(turns.unionByName(extra)))
    kind = turns.schema["conv_id"].dataType.simpleString()
    return (found.select(F.col("tree.conv_id").alias("conv_id"), "formatted", "loss")
            .mapInArrow(_digests, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                                  "loss_sha256 string, formatted_chars long"))


OP7_SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '{CONTROL}'), (-1, 1, 'assistant', '{CONTROL}'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('{START}') + length(role) + 1 + length('{END}') + 1
           + length(regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g')))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""
