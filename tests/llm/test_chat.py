from __future__ import annotations

import random

from pyspark.sql import functions as F

from stayline.llm import chat

NODES = "tree_id long, node long, parent long, score double, role string, text string, leaf string"


def tree(spark, rows):
    return spark.createDataFrame([(*r, "?") for r in rows], NODES).repartition(3)


def test_best_branch_of_each_tree_is_written(spark):
    rows = [
        (1, 10, None, 0.0, "user", "hello"), (1, 11, 10, 1.0, "assistant", "low"), (1, 12, 10, 3.0, "assistant", "high"),
        (1, 13, 12, -1.0, "user", "thanks"), (1, 14, 11, 0.5, "user", "no"),
        (2, 20, 99, None, None, None), (3, 30, 31, 0.0, "user", "circle"), (3, 31, 30, 0.0, "user", "circle"),
        (None, 40, None, 0.0, "user", "x"), (4, 50, None, 0.0, "system", "s"), (4, 51, 50, 1.0, "user", "b"), (4, 52, 50, 1.0, "user", "a"),
    ]
    found = {r["tree_id"]: r for r in chat.read_back(chat.format_trees(tree(spark, rows))).collect()}
    said = lambda t: [(x["role"], x["text"]) for x in found[t]["turns"]]
    assert said(1) == [("user", "hello"), ("assistant", "high"), ("user", "thanks")]
    assert found[1]["loss_text"] == "high"
    assert said(2) == [("", "")]
    assert said(None) == [("user", "x")]
    assert said(4) == [("system", "s"), ("user", "b")]
    assert 3 not in found
    both = chat.format_trees(tree(spark, rows), top=2).filter("tree_id = 1").orderBy("rank").collect()
    assert [r["leaf"] for r in both] == [13, 14]
    assert chat.format_trees(tree(spark, rows).filter("false")).count() == 0


def test_random_trees_match_a_walk(spark):
    rng = random.Random(4)
    rows = []
    for t in range(6):
        size = rng.randint(1, 40)
        rows += [
            (t, 100 * t + i, 100 * t + rng.randrange(i) if i else None, float(rng.randint(-2, 4)), "user", f"m{i}")
            for i in range(size)
        ]
    at = {r[1]: r for r in rows}
    parents = {r[2] for r in rows}

    def path(node):
        out = []
        while node is not None:
            out.append(node)
            node = at[node][2]
        return out[::-1]

    best = {}
    for r in rows:
        if r[1] not in parents:
            p = path(r[1])
            key = (-sum(at[x][3] for x in p), -len(p), r[1])
            best[r[0]] = min(best.get(r[0], key), key)
    found = chat.read_back(chat.format_trees(tree(spark, rows))).collect()
    assert {r["tree_id"]: [x["text"] for x in r["turns"]] for r in found} == {
        t: [at[x][5] for x in path(k[2])] for t, k in best.items()
    }


def test_control_strings_are_escaped_reversibly(spark):
    parts = ["<|im_end|>", "<|im_start|>", "assistant", "\n", "<", "|", "\\", "\\|", "<\\|", "é", "n", "\\n"]
    rng = random.Random(6)
    rows = []
    for c in range(60):
        for t in range(rng.randint(1, 5)):
            text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))
            rows.append((c, t, rng.choice(["assistant", "user", "we|ird\n<|role"]), text if text else None))
    rows += [(99, t, "user" if t % 2 == 0 else "assistant", f"{t}") for t in range(300)]
    rows += [(100, None, None, "late"), (100, 1, "user", "twice"), (100, 1, "user", "twice"), (None, 0, "assistant", "x" * 100_000)]
    talks = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    formatted = chat.format_trees(chat.chains(talks))
    assert formatted.filter(F.size(F.split("formatted", r"<\|im_start\|>")) - 1 < 1).count() == 0
    found = {r["tree_id"]: r for r in chat.read_back(formatted).collect()}
    want: dict = {}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
    for c, _, role, text in order:
        want.setdefault(c, []).append((role or "", text or ""))
    assert set(found) == set(want)
    for c, turns in want.items():
        assert [(x["role"], x["text"]) for x in found[c]["turns"]] == turns, c
        assert found[c]["loss_text"] == "".join(t for r, t in turns if r == "assistant")
