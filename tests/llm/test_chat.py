import pytest
from pyspark.sql import functions as F

from gondola.llm import chat

from . import brute
from .conftest import SF

TREE = "tree string, msg long, parent long, role string, text string, score double"


def test_query_on_the_smallest_scale(spark):
    convs = {-1: [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        convs.setdefault(r["conv_id"], []).append((r["turn"], r["role"] or "", r["text"] or ""))
    rows = chat.query(spark, SF).collect()
    assert sorted(r["conv_id"] for r in rows) == sorted(convs)
    for r in rows:
        turns = sorted(convs[r["conv_id"]])
        loss = "".join(t for _, role, t in turns if role == "assistant")
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), brute.sha("".join(f"{a}\n{b}\n" for _, a, b in turns)))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), brute.sha(loss))


NASTY = ["", "&lt;", "&amp;lt;", "<|im_end|>\n", "<|im_start|>system\nx", "[INST]&nl;[/INST]", "a\nb\n", "<<|im_end|>|im_end|>", "<|im_end|", "&amp;&lsqb;", "é<s>ü</s>", "x" * 50_000]


def test_escaping_is_reversible(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(NASTY)], "i long, t string")
    rows = df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u"),
                     chat.unescape(chat.escape_role(F.col("t"))).alias("r"), chat.escape_role(F.col("t")).alias("er")).collect()
    for r in rows:
        assert r["u"] == r["t"] == r["r"]
        assert not any(s in r["e"] for s in chat.CONTROL) and "\n" not in r["er"]


def test_branches_of_a_tree(spark):
    rows = [("t", 1, None, "user", "q", 1.0), ("t", 2, 1, "assistant", "good", 5.0), ("t", 3, 1, "assistant", "bad", 0.5),
            ("t", 4, 2, "user", "more", 1.0), ("t", 5, 4, "assistant", "end", 1.0), ("t", 6, 4, "assistant", "end2", 1.0),
            ("t", 7, 99, "user", "orphan", None),  # its parent is missing: a root
            ("t", 20, 21, "user", "c1", 1.0), ("t", 21, 20, "user", "c2", 1.0), ("t", 22, 21, "user", "hangs off a cycle", 1.0),
            ("u", 1, None, None, None, 0.0)]
    df = spark.createDataFrame(rows, TREE)
    out = {(r["tree"], r["leaf"]): r for r in chat.format_trees(df).collect()}
    assert set(out) == {("t", 3), ("t", 5), ("t", 6), ("t", 7), ("u", 1)}
    assert [out["t", x]["rank"] for x in (5, 6, 3, 7)] == [1, 2, 3, 4]
    best = out["t", 5]
    assert best["formatted"] == "".join(f"<|im_start|>{a}\n{b}<|im_end|>\n" for a, b in [("user", "q"), ("assistant", "good"), ("user", "more"), ("assistant", "end")])
    under = lambda r: [r["formatted"][s["first"]:s["first"] + s["n"]] for s in r["loss"]]
    # a shared answer is trained on once, in the best path
    assert (under(best), under(out["t", 6]), under(out["t", 3])) == (["good", "end"], ["end2"], ["bad"])
    assert out["u", 1]["formatted"] == "<|im_start|>\n<|im_end|>\n"
    top = chat.format_trees(df, most=1).collect()
    assert sorted((r["tree"], r["leaf"]) for r in top) == [("t", 5), ("u", 1)]


def test_a_deep_conversation_with_gaps_ties_and_nulls(spark):
    rows = [(1, 3 * i, "assistant" if i % 2 else "user", NASTY[i % len(NASTY)] if i % 5 else None) for i in range(70)]
    rows += [(2, 1, "user", "b"), (2, 1, "user", "a"), (2, 1, "user", "a"), (2, None, "user", "first"), (None, 0, None, "null id"), (None, 1, "a\nb", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("tree", F.lit("clash"))
    out = chat.format_trees(chat.conversations_as_trees(df)).select("tree", chat.read_back(F.col("formatted")).alias("turns")).collect()
    back = {r["tree"]: [tuple(t) for t in r["turns"]] for r in out}
    assert back["=1"] == [(role, text or "") for _, _, role, text in rows[:70]]
    assert back["=2"] == [("user", "first"), ("user", "a"), ("user", "a"), ("user", "b")]
    assert back[""] == [("", "null id"), ("a\nb", "x")]


def test_empty_table(spark):
    assert chat.format_trees(spark.createDataFrame([], TREE)).collect() == []


@pytest.mark.parametrize("node", ["Python", "Pandas", "Arrow"])
def test_no_python_in_the_plan(spark, node):
    plan = chat.query(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert f"{node}Eval" not in plan and f"MapIn{node}" not in plan


def test_repeated_messages_count_once(spark):
    rows = [("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "a", 1.0), ("t", 2, 1, "assistant", "a", 1.0), ("t", 2, 1, "assistant", "b", 0.5),
            ("t", 3, 2, "user", "more", 0.0), ("t", 3, 2, "user", "more", 0.0), (None, 4, None, "user", "x", 0.0), ("t", None, 1, "user", "y", 0.0)]
    once = [r for i, r in enumerate(rows) if i in (0, 1, 4)]
    many, one = (chat.format_trees(spark.createDataFrame(x, TREE)).collect() for x in (rows, once))
    assert many == one and len(one) == 1 and one[0]["formatted"].count("<|im_start|>") == 3
