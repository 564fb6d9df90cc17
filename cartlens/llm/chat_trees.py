"""Chat formatting of reply trees: enumerate paths, rank branches, format the chosen ones.

Only DataFrame functions.  Paths come from self-joins that double the jump length each round
(node -> 1st, 2nd, 4th ... ancestor), so a conversation of d turns needs about log2(d) rounds.
Rows of one conversation meet only in the last step, where they become one output row.

Defined results: rows without a conversation or node id are left out; of rows with the same
conversation and node one stays (the smallest parent, role, text, score); a parent that does
not exist makes its child a root; nodes on a cycle reach no root and are left out; null text
and role are empty; a null score counts 0; ties between branches go to the longer branch,
then to the smaller leaf; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartlens.llm.common import staged
from cartlens.llm.line_quality import let

BEGIN, TURN, END = "<|begin|>", "<|turn|>", "<|end|>\n"
#: Every control string starts with one of these; a text holds them only in escaped form.
ESCAPES = (("\\", "\\0"), ("<", "\\1"), ("[", "\\2"))
ROLE_ESCAPES = ESCAPES + (("\n", "\\3"),)


def escape(text: Column, pairs=ESCAPES) -> Column:
    for plain, coded in pairs:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column, pairs=ROLE_ESCAPES) -> Column:
    """Inverse of ``escape``: each backslash is followed by its own digit, so order is safe."""
    for plain, coded in reversed(pairs):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def from_turns(turns: DataFrame) -> DataFrame:
    """A table of linear conversations (conv_id, turn, role, text) as a reply tree.

    Rows in the order of turn (ties by role, text) reply to one another; all rows stay.
    """
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    n = F.row_number().over(w).cast("long")
    return (turns.select("conv_id", n.alias("node_id"), "role", "text")
            .select("conv_id", "node_id", F.when(F.col("node_id") > 1, F.col("node_id") - 1).alias("parent_id"),
                    "role", "text", F.lit(0.0).alias("score")))


def best_paths(nodes: DataFrame, branches: int | None = 1) -> DataFrame:
    """Root-to-leaf paths of the ``branches`` best-scored leaves of each conversation (None: all).

    Input: conv_id, node_id, parent_id, role, text, score.  Output: conv_id, leaf_id,
    branch_rank, path_score, position (0 at the root), node_id, role, text.
    """
    node = (nodes.where("conv_id IS NOT NULL AND node_id IS NOT NULL")
            .groupBy("conv_id", "node_id")
            .agg(F.min(F.struct("parent_id", "role", "text", "score")).alias("r"))
            .select("conv_id", "node_id", "r.*"))
    node = staged(node)
    ids = node.select("conv_id", F.col("node_id").alias("parent_id"), F.lit(True).alias("there"))
    jump = (node.join(ids, ["conv_id", "parent_id"], "left")
            .select("conv_id", "node_id", F.when(F.col("there"), F.col("parent_id")).alias("up"),
                    F.when(F.col("there"), 1).otherwise(0).cast("long").alias("hops"),
                    F.coalesce("score", F.lit(0.0)).alias("total")))
    live, done, jumps = staged(jump), [], []
    longest = node.count()               # no path is longer; more rounds would walk a cycle
    while 1 << len(jumps) <= 2 * longest + 1:
        done.append(live.where("up IS NULL"))            # these have reached their root
        live = live.where("up IS NOT NULL")
        if not live.limit(1).count():
            break
        jumps.append(live)
        ahead = live
        for d in done:
            ahead = ahead.unionByName(d)
        ahead = ahead.select("conv_id", F.col("node_id").alias("up"), F.col("up").alias("up2"),
                             F.col("hops").alias("hops2"), F.col("total").alias("total2"))
        live = staged(live.join(ahead, ["conv_id", "up"]).select(
            "conv_id", "node_id", F.col("up2").alias("up"), (F.col("hops") + F.col("hops2")).alias("hops"),
            (F.col("total") + F.col("total2")).alias("total")))
    reached = done[0]
    for d in done[1:]:
        reached = reached.unionByName(d)
    parents = node.select("conv_id", F.col("parent_id").alias("node_id")).where("node_id IS NOT NULL")
    order = Window.partitionBy("conv_id").orderBy(F.desc("total"), F.desc("hops"), "node_id")
    leaves = (reached.join(parents, ["conv_id", "node_id"], "left_anti")
              .withColumn("branch_rank", F.row_number().over(order)))
    if branches is not None:
        leaves = leaves.where(F.col("branch_rank") <= branches)
    path = leaves.select("conv_id", F.col("node_id").alias("leaf_id"), "branch_rank",
                         F.col("total").alias("path_score"), F.col("hops").alias("position"), "node_id")
    for k, j in enumerate(jumps):
        j = j.select("conv_id", "node_id", "up")
        more = (path.join(j, ["conv_id", "node_id"])
                .select("conv_id", "leaf_id", "branch_rank", "path_score",
                        (F.col("position") - F.lit(1 << k)).alias("position"), F.col("up").alias("node_id")))
        path = staged(path.unionByName(more))
    return path.join(node.select("conv_id", "node_id", "role", "text"), ["conv_id", "node_id"])


def format_paths(paths: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One conversation per path: formatted text and the spans (start, length) under the loss."""
    w = Window.partitionBy("conv_id", "leaf_id").orderBy("position")
    one = paths.select(
        "conv_id", "leaf_id", "branch_rank", "path_score", "position",
        F.concat(F.lit(TURN), escape(F.coalesce("role", F.lit("")), ROLE_ESCAPES), F.lit("\n")).alias("head"),
        escape(F.coalesce("text", F.lit(""))).alias("body"),
        F.coalesce(F.col("role") == loss_role, F.lit(False)).alias("loss"))
    one = one.withColumn("piece", F.concat("head", "body", F.lit(END))).withColumn(
        "start", F.sum(F.length("piece")).over(w) - F.length("body") - len(END) + len(BEGIN))
    rows = F.array_sort(F.collect_list(F.struct(
        "position", "piece", "loss", F.col("start").cast("int").alias("start"),
        F.length("body").alias("length"))))
    return (one.groupBy("conv_id", "leaf_id", "branch_rank", "path_score").agg(rows.alias("r"))
            .select("conv_id", "leaf_id", "branch_rank", "path_score",
                    F.concat(F.lit(BEGIN), F.array_join("r.piece", "")).alias("formatted"),
                    F.transform(F.filter("r", lambda x: x["loss"]),
                                lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length"))).alias("loss_spans")))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    body = F.substring(formatted, len(BEGIN) + 1, 2**31 - 1 - len(BEGIN))
    parts = F.filter(F.split(body, r"<\|turn\|>"), lambda x: x != "")
    return F.transform(parts, lambda p: let(F.substring_index(p, "\n", 1), lambda role: F.struct(
        unescape(role).alias("role"),
        unescape(F.substr(p, F.length(role) + 2, F.length(p) - F.length(role) - 1 - len(END))).alias("text"))))


EXTRA = """SELECT * FROM VALUES
 (CAST(-1 AS BIGINT), CAST(0 AS BIGINT), 'user', '</s>[INST] ok [/INST]'),
 (CAST(-1 AS BIGINT), CAST(1 AS BIGINT), 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)"""


def query(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    turns = conversations.select("conv_id", "turn", "role", "text").unionByName(spark.sql(EXTRA))
    done = format_paths(best_paths(from_turns(turns)))
    back = done.select("conv_id", "formatted", read_back(F.col("formatted")).alias("turns"),
                       F.array_join(F.transform("loss_spans", lambda s: unescape(
                           F.substr("formatted", s["start"] + 1, s["length"]))), "").alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def _escaped_length(name: str, pairs) -> str:
    out = name
    for plain, coded in pairs:
        out = f"replace({out}, {'chr(10)' if plain == chr(10) else repr(plain)[0] + plain + repr(plain)[0]}, '{coded}')"
    return f"length({out})"


ORACLE = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  ({len(BEGIN)} + sum({len(TURN)} + {_escaped_length('role', ROLE_ESCAPES)} + 1
     + {_escaped_length('text', ESCAPES)} + {len(END)}))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
