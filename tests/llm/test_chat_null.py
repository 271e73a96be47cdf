"""Conversations without an id."""

from tidemark.llm import chat


def test_rows_with_a_null_conv_id_are_one_conversation(spark):
    rows = [(None, 0, "user", "hi"), (None, 1, "assistant", "yes"), (3, 0, "user", "other")]
    nodes = chat.linear_nodes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    out = chat.format_paths(chat.rank_branches(nodes).filter("branch_rank = 1"), nodes).collect()
    assert {r["tree"]: chat.parse(r["formatted"]) for r in out} == {None: [("user", "hi"), ("assistant", "yes")], 3: [("user", "other")]}
