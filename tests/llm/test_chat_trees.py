from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from cartlens.llm import chat_trees as C

NODE = "conv_id long, node_id long, parent_id long, role string, text string, score double"


def _brute(rows, branches):
    nodes = {}
    for r in rows:
        if r[0] is not None and r[1] is not None:
            key = tuple((x is not None, x) for x in r[2:])
            if (r[0], r[1]) not in nodes or key < nodes[r[0], r[1]][0]:
                nodes[r[0], r[1]] = (key, r)
    nodes = {k: v[1] for k, v in nodes.items()}
    parents = {(c, r[2]) for (c, _), r in nodes.items() if (c, r[2]) in nodes}
    found: dict = {}
    for c, n in nodes:
        if (c, n) in parents:
            continue
        path, at = [], n
        while (c, at) in nodes and at not in path:
            path.append(at)
            at = nodes[c, at][2]
        if at in path:
            continue
        score = sum(nodes[c, x][5] or 0.0 for x in path)
        found.setdefault(c, []).append((-score, -len(path), n, path[::-1]))
    return {(c, leaf): path for c, all_ in found.items() for _, _, leaf, path in (sorted(all_)[:branches] if branches else all_)}


def test_paths_equal_brute_force(spark):
    rng = random.Random(2)
    rows = [(1, k, k - 1 if k else None, "user", "t", 0.0) for k in range(70)]                    # a long chain
    rows += [(2, 1, 2, "a", "x", 1.0), (2, 2, 1, "a", "x", 1.0), (2, 3, 99, None, None, None)]      # a cycle, an orphan
    rows += [(3, 5, 5, "a", "x", 1.0), (None, 1, None, "a", "x", 1.0), (4, None, None, "a", "x", 1.0)]
    for c in range(10, 30):
        for k in range(rng.randrange(1, 40)):
            rows.append((c, k, rng.randrange(k) if k and rng.random() < 0.95 else None, rng.choice(["user", "assistant"]),
                         rng.choice(["", "<x>", None]), float(rng.randrange(3))))
    rows += [rows[0], (10, 0, None, "zzz", "later", 9.0)]
    nodes = spark.createDataFrame(rows, NODE)
    for branches in (1, 2, None):
        got: dict = {}
        for r in C.best_paths(nodes, branches).collect():
            got.setdefault((r.conv_id, r.leaf_id), []).append((r.position, r.node_id))
        assert {k: [n for _, n in sorted(v)] for k, v in got.items()} == _brute(rows, branches)
        assert all([p for p, _ in sorted(v)] == list(range(len(v))) for v in got.values())
    assert C.best_paths(nodes.limit(0)).count() == 0


NASTY = ["</s>[INST] ok [/INST]", C.BEGIN, C.TURN + "user\n", C.END, "\\0\\1\\2\\3", "\\", "a\nb\\", "[[<<\\<", "", "日本 \U00010348 é", "\\\\1"]


def test_escapes_are_reversible_and_hide_control_strings(spark):
    rows = spark.createDataFrame([(t,) for t in NASTY], "t string").select(
        "t", C.escape(F.col("t")).alias("e"), C.escape(F.col("t"), C.ROLE_ESCAPES).alias("r"))
    for r in rows.select("*", C.unescape(F.col("e")).alias("b"), C.unescape(F.col("r")).alias("c")).collect():
        assert r.t == r.b == r.c and "<" not in r.e and "[" not in r.e and "\n" not in r.r


def test_query_reads_back_what_went_in(spark):
    rows = [(i, k, role, t) for i, role in enumerate(["user", "assistant", "sys\ntem", None, C.TURN]) for k, t in enumerate(NASTY)]
    rows += [(9, None, "assistant", None), (9, 1, "assistant", "x"), (9, 1, "assistant", "x"), (9, 1, "assistant", "w"), (None, 1, "user", "lost")]
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, leaf_id int")
    got = {r.conv_id: r for r in C.query(spark, table).collect()}
    rows += [(-1, 0, "user", NASTY[0]), (-1, 1, "assistant", NASTY[0])]
    assert set(got) == {r[0] for r in rows} - {None}
    for c, r in got.items():
        mine = sorted((x for x in rows if x[0] == c), key=lambda x: tuple((v is not None, v) for v in x[1:]))
        said = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in mine)
        loss = "".join(x[3] or "" for x in mine if x[2] == "assistant")
        assert r.n_turns == len(mine) and r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert C.query(spark, table.limit(0)).count() == 1
