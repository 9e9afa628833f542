"""Reply trees formatted as conversations.

Messages name their parent; every root-to-leaf path of a tree is one
conversation.  Paths are enumerated by iterative self-joins that double their
reach (a message's parent, then the ancestor 2, 4, 8 ... levels up), so a tree
of depth d takes log2(d) rounds.  Branches are ranked by the sum of their
messages' scores, and each chosen path becomes one text with a loss mask over
assistant texts; a message that several chosen paths share is under the mask
of the best of them only.

Only DataFrame functions are used.  All joins are on (tree, message), which
spreads a tree that holds a third of all messages over every task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import cut, rank_within

# The template's markers, and control strings of it and of other
# common templates, which are escaped inside texts.
START, END = "<|im_start|>", "<|im_end|>"
CONTROL = [START, END, "<|endoftext|>", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]"]
# The ampersand comes first: it is escaped before the entities that hold one.
ENTITIES = {"&": "&amp;", "<": "&lt;", "[": "&lsqb;", "\n": "&nl;"}


def escape(c: Column) -> Column:
    """Null as empty; the first character of a control string becomes an entity.

    An ampersand that would read as an entity is escaped first, so
    ``unescape`` gives back exactly the text.
    """
    c = reduce(lambda x, e: F.replace(x, F.lit(e), F.lit("&amp;" + e[1:])), ENTITIES.values(), F.coalesce(c, F.lit("")))
    return reduce(lambda x, s: F.replace(x, F.lit(s), F.lit(ENTITIES[s[0]] + s[1:])), CONTROL, c)


def escape_role(c: Column) -> Column:
    """As ``escape``; a role ends at its line, so line ends become entities too."""
    return F.replace(escape(c), F.lit("\n"), F.lit("&nl;"))


def unescape(c: Column) -> Column:
    # the ampersand last: "&amp;lt;" is the text "&lt;"
    return reduce(lambda x, s: F.replace(x, F.lit(ENTITIES[s]), F.lit(s)), ["<", "[", "\n", "&"], c)


def root_to_leaf(messages: DataFrame) -> DataFrame:
    """(tree, leaf, msg, up): every message of every path, ``up`` levels above its leaf.

    ``messages`` has tree, msg, parent (unique msg in a tree, none null).  A
    message whose parent is null or missing is a root; messages on a cycle of
    parents have no root and belong to no path.
    """
    links = messages.where("parent IS NOT NULL").join(
        messages.select("tree", F.col("msg").alias("parent")), ["tree", "parent"], "left_semi").select("tree", "msg", "parent")
    jump = cut(links.select("tree", "msg", F.col("parent").alias("anc")))
    paths = cut(messages.join(links.select("tree", F.col("parent").alias("msg")), ["tree", "msg"], "left_anti")
                .select("tree", F.col("msg").alias("leaf"), "msg", F.lit(0).alias("up")))
    deepest = messages.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    reach = 1
    while reach < deepest and not jump.isEmpty():
        further = paths.join(jump, ["tree", "msg"]).select("tree", "leaf", F.col("anc").alias("msg"), (F.col("up") + reach).alias("up"))
        paths = cut(paths.unionByName(further))
        second = jump.select("tree", F.col("msg").alias("anc"), F.col("anc").alias("far"))
        jump = cut(jump.join(second, ["tree", "anc"]).select("tree", "msg", F.col("far").alias("anc")))
        reach *= 2
    roots = messages.join(links, ["tree", "msg"], "left_anti").select("tree", "msg")
    rooted = paths.join(roots, ["tree", "msg"]).select("tree", "leaf")
    return paths.join(rooted, ["tree", "leaf"], "left_semi")


def ranked_paths(messages: DataFrame, most: int | None = None) -> DataFrame:
    """``root_to_leaf`` with each path's score and rank in its tree (best first, then leaf).

    ``most`` keeps that many paths of a tree; by default all stay.
    """
    steps = root_to_leaf(messages).join(messages.select("tree", "msg", F.coalesce("score", F.lit(0.0)).alias("score")), ["tree", "msg"])
    scored = steps.groupBy("tree", "leaf").agg(F.sum("score").alias("path_score"))
    ranked = rank_within(scored, "tree", [F.col("path_score").desc(), "leaf"], "rank")
    if most is not None:
        ranked = ranked.where(F.col("rank") <= most)
    return steps.drop("score").join(ranked, ["tree", "leaf"])


def one_of_each(messages: DataFrame) -> DataFrame:
    """One row for each (tree, msg): of repeated or contradicting rows the
    smallest by parent, role, text and score (null first); without tree or msg none."""
    rest = F.min(F.struct("parent", "role", "text", "score")).alias("m")
    return messages.where("tree IS NOT NULL AND msg IS NOT NULL").groupBy("tree", "msg").agg(rest).select("tree", "msg", "m.*")


def format_trees(messages: DataFrame, most: int | None = None, unique: bool = False) -> DataFrame:
    """(tree, leaf, rank, path_score, formatted, loss) from tree, msg, parent, role, text, score.

    ``loss`` lists the spans (first code point from 0, code points) of the
    assistant texts in ``formatted``.  Null roles, texts and scores count as
    empty and zero; repeated messages count once (``one_of_each``, left out if
    ``unique`` says that there are none); branches of one score are ranked by
    their leaf; very long texts stay whole; an empty table gives an empty one; other
    columns are not carried.
    """
    messages = messages.select("tree", "msg", "parent", "role", "text", "score")
    messages = cut(messages if unique else one_of_each(messages))
    steps = ranked_paths(messages, most).join(messages.select("tree", "msg", "role", "text"), ["tree", "msg"])
    # the best path that holds a message trains on it
    best = steps.groupBy("tree", "msg").agg(F.min("rank").alias("best"))
    trained = (F.coalesce(F.col("role"), F.lit("")) == "assistant") & (F.col("rank") == F.col("best"))
    steps = steps.join(best, ["tree", "msg"]).withColumn("trained", trained)
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    parts = steps.select("tree", "leaf", "rank", "path_score", "up", "trained", head.alias("head"), escape(F.col("text")).alias("body"))
    parts = parts.select("*", F.concat("head", "body", F.lit(END + "\n")).alias("turn"))
    in_path = W.partitionBy("tree", "leaf").orderBy(F.col("up").desc())
    at = F.coalesce(F.sum(F.length("turn")).over(in_path.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = parts.select("tree", "leaf", "rank", "path_score", "up", "turn", (at + F.length("head")).alias("first"),
                          F.length("body").alias("n"), "trained")
    turns = placed.groupBy("tree", "leaf").agg(
        F.first("rank").alias("rank"), F.first("path_score").alias("path_score"),
        F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("depth"), "turn", "first", "n", "trained"))).alias("turns"))
    spans = F.transform(F.filter("turns", lambda t: t["trained"]), lambda t: F.struct(t["first"].alias("first"), t["n"].alias("n")))
    return turns.select("tree", "leaf", "rank", "path_score", F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"),
                        spans.alias("loss"))


def read_back(formatted: Column) -> Column:
    """The (role, text) turns of a formatted conversation."""
    turns = F.split(formatted, r"<\|im_end\|>\n")
    inner = F.transform(F.slice(turns, F.lit(1), F.size(turns) - 1), lambda t: F.substring(t, F.lit(len(START) + 1), F.length(t)))
    return F.transform(inner, lambda t: F.struct(
        unescape(F.substring_index(t, "\n", 1)).alias("role"),
        unescape(F.substring(t, F.locate("\n", t) + 1, F.length(t))).alias("text")))


def trained_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, (s["first"] + 1).cast("int"), s["n"]))), "")


def conversations_as_trees(conversations: DataFrame) -> DataFrame:
    """Rows of a conversation by turn (then role, text), each the reply to the one before.

    A null conv_id is a conversation of its own; repeated rows are repeated turns.
    """
    # the tree key tells a null conv_id from every text
    tree = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    rows = rank_within(conversations.select(tree.alias("tree"), "turn", "role", "text"), "tree", ["turn", "role", "text"], "msg")
    return rows.select("tree", "msg", F.when(F.col("msg") > 1, F.col("msg") - 1).alias("parent"), "role", "text",
                       F.lit(1.0).alias("score"))


# ---------------------------------------------------------------- query

def query(spark, sf_dir: str) -> DataFrame:
    """Contract form: one row per conversation, read back from the formatted text."""
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    done = format_trees(conversations_as_trees(given.unionByName(extra)), unique=True)  # numbered by rank
    back = done.select(F.nullif(F.substring("tree", 2, 40), F.lit("")).cast("long").alias("conv_id"), "formatted",
                       read_back(F.col("formatted")).alias("turns"), trained_text(F.col("formatted"), F.col("loss")).alias("trained"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                       F.length("trained").cast("long").alias("loss_chars"), F.sha2("trained", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def _sql_escape(c: str) -> str:
    for e in ENTITIES.values():
        c = f"replace({c}, '{e}', '&amp;{e[1:]}')"
    for s in CONTROL:
        c = f"replace({c}, '{s}', '{ENTITIES[s[0]]}{s[1:]}')"
    return c


SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('{START}') + length(replace({_sql_escape('role')}, chr(10), '&nl;')) + 1 + length({_sql_escape('text')})
                + length('{END}') + 1) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
