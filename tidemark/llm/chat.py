"""Chat formatting of reply trees.

Messages that answer one another form trees. Root-to-leaf paths are found by
self-joins that double their reach: the join of round k takes each leaf's path
from 2^k to 2^(k+1) messages, so a conversation of n turns needs log2(n)
rounds. Only ids take part. Branches are ranked by the sum of their messages'
scores, and each chosen path is formatted as one conversation.

Template: ``<|im_start|>role<|im_sep|>text<|im_end|>`` for each turn. In roles
and texts, backslashes are doubled and a backslash goes in after the first
character of each control string, so that no text can look like a control
string and reading back is exact. The loss mask covers assistant texts alone,
as code point ranges of the formatted string.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import work_dir

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Control strings of this and other chat templates.
CONTROLS = (START, SEP, END, "<|system|>", "<|user|>", "<|assistant|>", "<|endoftext|>",
            "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
LEARNED = "assistant"
_CONTROL = re.compile("|".join(map(re.escape, sorted(CONTROLS, key=len, reverse=True))))
_TURN = re.compile(f"{re.escape(START)}(.*?){re.escape(SEP)}(.*?){re.escape(END)}", re.DOTALL)

_RANGE = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
FORMATTED = T.StructType([T.StructField("text", T.StringType()),
                          T.StructField("loss", T.ArrayType(_RANGE))])


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", lambda m: m[1], text)


def format_turns(turns: list[dict]) -> dict:
    """The conversation as one string, with the ranges to learn."""
    parts, loss, at = [], [], 0
    for turn in turns:
        role, text = escape(turn["role"] or ""), escape(turn["text"] or "")
        head = START + role + SEP
        if (turn["role"] or "") == LEARNED:
            loss.append({"start": at + len(head), "end": at + len(head) + len(text)})
        parts.append(head + text + END)
        at += len(parts[-1])
    return {"text": "".join(parts), "loss": loss}


def read_turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(text)]


def read_loss(text: str, loss: list[dict]) -> list[str]:
    """The learned texts of a formatted conversation."""
    return [unescape(text[s["start"]:s["end"]]) for s in loss]


@F.arrow_udf(FORMATTED)
def _format(paths: pa.Array) -> pa.Array:
    kind = pa.struct([("text", pa.string()), ("loss", pa.list_(
        pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
    return pa.array((format_turns(p.as_py()) for p in paths), kind)


def paths(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, node, dist): each leaf's path, dist messages above the leaf.

    ``nodes`` has tree, node (distinct within a tree) and parent. A parent that
    the tree lacks makes its child a root. Nodes on or below a cycle of parents
    reach no root and are left out.
    """
    work_dir(nodes.sparkSession)
    same = lambda a, b, x, y: (
        F.col(f"{a}.tree").eqNullSafe(F.col(f"{b}.tree")) & (F.col(f"{a}.{x}") == F.col(f"{b}.{y}")))
    ids = nodes.select("tree", "node", "parent").checkpoint()
    up = (ids.alias("a").join(ids.alias("b"), same("a", "b", "parent", "node"))
          .select("a.tree", "a.node", F.col("a.parent").alias("up")).checkpoint())
    jumps, reach = [], 1
    longest = ids.groupBy("tree").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    while not up.isEmpty():
        if reach > longest:                      # still going up: on or below a cycle
            ids = ids.alias("a").join(up.alias("b"), same("a", "b", "node", "node"), "left_anti")
            break
        jumps.append(up)
        up = (up.alias("a").join(up.alias("b"), same("a", "b", "up", "node"))
              .select("a.tree", "a.node", F.col("b.up").alias("up")).checkpoint())
        reach *= 2
    leaves = ids.alias("a").join(ids.alias("b"), same("a", "b", "node", "parent"), "left_anti")
    path = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).alias("dist"))
    for k, up in enumerate(jumps):
        path = path.unionByName(
            path.alias("a").join(up.alias("b"), same("a", "b", "node", "node"))
            .select("a.tree", "a.leaf", F.col("b.up").alias("node"),
                    (F.col("a.dist") + (1 << k)).alias("dist"))).checkpoint()
    return path


def chosen_paths(nodes: DataFrame, path: DataFrame, keep: int | None = None) -> DataFrame:
    """(tree, leaf, branch): leaves by the score of their path, best first, ties to
    the smaller leaf; the first ``keep`` of each tree, or all."""
    one = (F.col("p.tree").eqNullSafe(F.col("n.tree"))) & (F.col("p.node") == F.col("n.node"))
    score = (path.alias("p").join(nodes.select("tree", "node", "score").alias("n"), one)
             .groupBy("p.tree", "p.leaf").agg(F.sum(F.coalesce("score", F.lit(0.0))).alias("score")))
    order = Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")
    ranked = score.withColumn("branch", F.row_number().over(order))
    return ranked if keep is None else ranked.where(F.col("branch") <= keep)


def format_trees(messages: DataFrame, keep: int | None = None) -> DataFrame:
    """One formatted conversation a chosen path: tree, leaf, branch, score,
    n_turns, conversation (text, and the loss mask's ranges).

    ``messages``: tree, node, parent, role, text, score. Null texts and roles
    are empty, null scores zero, a null tree is a tree like any other. Messages
    with a null node are left out, as nothing can link them; of messages that
    share one, the smallest by (parent, role, text, score) counts. An empty
    table gives no row.
    """
    nodes = (messages.where(F.col("node").isNotNull()).groupBy("tree", "node")
             .agg(F.min(F.struct("parent", "role", "text", "score")).alias("m"))
             .select("tree", "node", "m.*"))
    path = paths(nodes)
    best = chosen_paths(nodes, path, keep)
    on = lambda a, b, c: (F.col(f"{a}.tree").eqNullSafe(F.col(f"{b}.tree"))
                          & (F.col(f"{a}.{c}") == F.col(f"{b}.{c}")))
    rows = path.alias("p").join(best.alias("b"), on("p", "b", "leaf")).select(
        "p.*", "b.branch", "b.score")
    turns = (rows.alias("p").join(nodes.alias("n"), on("p", "n", "node"))
             .groupBy("p.tree", "p.leaf", "p.branch", "p.score")
             .agg(F.array_sort(F.collect_list(F.struct(
                 (-F.col("p.dist")).alias("at"), "n.role", "n.text"))).alias("turns")))
    return turns.select("tree", "leaf", "branch", "score", F.size("turns").alias("n_turns"),
                        _format("turns").alias("conversation"))
