"""Conversation trees formatted for training, by iterative self-joins.

``rank_branches`` enumerates root-to-leaf paths: every node starts with the hop
to its parent, and each round joins the table with itself so that hops double;
paths of any depth are whole after log2(depth) rounds. Branches of a tree are
ranked by score. ``format_paths`` gives each chosen path as one string with the
spans of its loss mask, and ``parse`` reads such a string back.

The template is ``<turn:ROLE>TEXT</turn>`` for each turn. Inside roles and
texts a backslash goes before each backslash, '<' and '>', so a text can't hold
a mark, and taking these backslashes away gives the text back.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, written

_ESCAPE, _UNESCAPE = re.compile(r"[\\<>]"), re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<turn:((?:[^\\<>]|\\.)*)>((?:[^\\<>]|\\.)*)</turn>", re.S)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def format_turns(turns: list[tuple[str, str]], loss_roles: tuple[str, ...] = ("assistant",)) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and where in it the texts under the loss mask stand (code points)."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"<turn:{escape(role)}>", escape(text)
        if role in loss_roles:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, "</turn>"]
        at += len(head) + len(body) + len("</turn>")
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def rank_branches(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, path, branch_score, branch_rank) of every root-to-leaf path; nodes: tree, node, parent, score.

    path lists the nodes from the root. A node without a parent, or with one that
    isn't in its tree, is a root; a branch that comes from a cycle is left out.
    branch_score is the mean of the path's scores (null counts as 0); rank 1 is the
    best of its tree, ties go to the lesser leaf. (tree, node) must be unique; a null tree is a tree.
    """
    # Inside a struct a null tree joins like any other.
    own = written(nodes.select(F.struct("tree").alias("tree"), "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")), "tree")
    known = own.select("tree", F.col("node").alias("parent"))
    links = own.filter("parent is not null").join(known, ["tree", "parent"], "left_semi")
    # jumps: from each node to the one 2**k above it. seen: the nodes less than 2**k above each leaf.
    jumps = written(links.select("tree", "node", F.col("parent").alias("above")), "jumps")
    parents = jumps.select("tree", F.col("above").alias("node"))
    seen = written(own.join(parents, ["tree", "node"], "left_anti").select("tree", F.col("node").alias("leaf"), "node", F.lit(0).alias("hops")), "seen")
    roots = own.select("tree", "node").join(jumps.select("tree", "node"), ["tree", "node"], "left_anti")
    roots = written(roots, "roots")
    largest = own.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    hop = 1
    while hop <= largest and not jumps.isEmpty():
        further = seen.join(jumps, ["tree", "node"]).select("tree", "leaf", F.col("above").alias("node"), (F.col("hops") + hop).alias("hops"))
        new_seen = written(seen.unionByName(further), "seen")
        upper = jumps.select("tree", F.col("node").alias("above"), F.col("above").alias("next"))
        new_jumps = written(jumps.join(upper, ["tree", "above"]).select("tree", "node", F.col("next").alias("above")), "jumps")
        discard(seen)
        discard(jumps)
        seen, jumps, hop = new_seen, new_jumps, 2 * hop
    step = F.struct((-F.col("hops")).alias("hops"), "node", "score", "root")
    ends = roots.withColumn("root", F.lit(1))
    steps = seen.join(own.select("tree", "node", "score"), ["tree", "node"]).join(ends, ["tree", "node"], "left")
    whole = steps.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(step)).alias("steps"), F.avg("score").alias("branch_score"), F.count("root").alias("roots")).filter("roots > 0")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("branch_score"), "leaf"))
    return whole.select(F.col("tree.tree").alias("tree"), "leaf", F.col("steps.node").alias("path"), "branch_score").withColumn("branch_rank", rank)


def format_paths(paths: DataFrame, nodes: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(tree, leaf, formatted, loss_spans) of each chosen path; nodes: tree, node, role, text.

    Null roles and texts count as empty.
    """
    places = paths.select(F.struct("tree").alias("tree"), "leaf", F.posexplode("path").alias("pos", "node"))
    turn = F.struct("pos", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = places.join(nodes.select(F.struct("tree").alias("tree"), "node", "role", "text"), ["tree", "node"]).groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [format_turns([(t["role"], t["text"]) for t in turns], loss_roles) for turns in batch.column(2).to_pylist()]
            spans = pa.array([[{"start": a, "end": b} for a, b in s] for _, s in made], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([f for f, _ in made], pa.string()), spans], names=["tree", "leaf", "formatted", "loss_spans"])

    turns = turns.select("tree.tree", "leaf", "turns")
    kind = dict(turns.dtypes)
    return turns.mapInArrow(rows, f"tree {kind['tree']}, leaf {kind['leaf']}, formatted string, loss_spans array<struct<start: long, end: long>>")


def linear_nodes(conversations: DataFrame) -> DataFrame:
    """Nodes (tree, node, parent, score, role, text) of conversations whose rows answer each other in the order of turn.

    node counts the rows of a conversation from 0; rows of one turn follow each other
    by role and text. Rows with a null conv_id are one conversation.
    """
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = conversations.select(F.col("conv_id").alias("tree"), "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    node = F.row_number().over(order) - 1
    return rows.withColumn("node", node).select("tree", "node", F.when(F.col("node") > 0, F.col("node") - 1).alias("parent"), F.lit(0.0).alias("score"), "role", "text")
