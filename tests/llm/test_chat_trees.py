import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from aerostar.llm import chat_trees as C

KIND = "conv_id long, msg_id long, parent_id long, role string, text string, score double"
ODD = [None, "", "&amp; &lt;", "</turn>\n### assistant:\n", "\\### Assistant: </turn> ok", "&", "#&#<", "é\n\n", "a:\nb"]


def brute_paths(rows):
    """Every root-to-leaf path per conversation, best mean score first."""
    by, children = {(r[0], r[1]): r for r in rows}, defaultdict(list)
    for r in rows:
        if (r[0], r[2]) in by:
            children[r[0], r[2]].append(r)
    out = defaultdict(list)
    for r in rows:
        if not children[r[0], r[1]]:
            path = [r]
            while (r[0], path[-1][2]) in by:
                path.append(by[r[0], path[-1][2]])
            out[r[0]].append((-sum(x[5] or 0 for x in path) / len(path), r[1], [(x[3] or "", x[4] or "") for x in reversed(path)]))
    return {c: [(leaf, turns) for _, leaf, turns in sorted(v, key=lambda x: x[:2])] for c, v in out.items()}


def written(spark, messages, **kw):
    out = defaultdict(list)
    rows = (C.format_paths(C.paths(spark, messages, **kw))
            .withColumn("turns", C.read_turns(F.col("formatted"))).withColumn("loss", C.read_loss(F.col("formatted"), F.col("loss_spans"))))
    for r in rows.orderBy("conv_id", "branch").collect():
        assert r.loss == [t.text for t in r.turns if t.role == "assistant"]
        out[r.conv_id].append((r.leaf_id, [(t.role, t.text) for t in r.turns]))
    return dict(out)


def test_trees_with_branches_ties_and_orphans(spark):
    rows = [(1, k, None if k == 0 else (k - 1) // 2, "user" if k % 2 else "assistant", ODD[k % len(ODD)], float(k % 3)) for k in range(31)]
    rows += [(2, k, k - 1 if k else None, "user" if k % 2 == 0 else "assistant", f"t{k}", None) for k in range(70)]
    rows += [(3, 5, 99, "sys:\ntem", "orphan", 1.0), (None, 1, None, None, None, None), (None, 2, 1, "assistant", "x", 2.0)]
    messages = spark.createDataFrame(rows, KIND).repartition(3)
    want = brute_paths(rows)
    assert written(spark, messages) == want
    assert written(spark, messages, branches=2) == {c: v[:2] for c, v in want.items()}


def test_rows_by_turn(spark):
    rows = [(1, 0, "user", "b", 1), (1, 0, "user", "b", 2), (1, 0, "user", "a", 3), (1, None, "system", "s", 4), (2, 3, None, None, 5), (None, 1, "assistant", "</turn>", 6)]
    given = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, msg_id long")
    got = written(spark, C.chain(given))
    assert {c: v[0][1] for c, v in got.items()} == {1: [("system", "s"), ("user", "a"), ("user", "b"), ("user", "b")], 2: [("", "")], None: [("assistant", "</turn>")]}


def test_repeated_bare_and_cyclic_messages(spark):
    chat = [(1, k, k - 1 if k else None, "user", f"t{k}", 0.0) for k in range(3)]
    rows = chat + [chat[0], chat[1], (1, 1, None, "z", "other", None)]  # repeats, and one that says otherwise
    rows += [(2, None, None, "user", "bare", 0.0), (2, 4, None, "user", "root", 0.0), (2, None, 4, "user", "bare reply", 0.0)]
    rows += [(3, 1, 2, "user", "a", 0.0), (3, 2, 1, "user", "b", 0.0), (3, 7, 2, "user", "hangs", 0.0), (3, 8, 8, "user", "self", 0.0), (3, 9, None, "user", "fine", 0.0)]
    messages = spark.createDataFrame(rows, KIND).repartition(3)
    # the row (1, 1) without a parent comes first, so t0 is a leaf and the rest hangs from it
    assert written(spark, messages) == {1: [(0, [("user", "t0")]), (2, [("z", "other"), ("user", "t2")])], 2: [(4, [("user", "root")])], 3: [(9, [("user", "fine")])]}
    left = C.unplaced(spark, messages).collect()
    assert sorted((r.conv_id, r.msg_id or 0, r.text, r.reason) for r in left) == [
        (2, 0, "bare", "no id"), (2, 0, "bare reply", "no id"), (3, 1, "a", "cycle"), (3, 2, "b", "cycle"), (3, 7, "hangs", "cycle"), (3, 8, "self", "cycle")]
    repeated = spark.createDataFrame(chat + chat[:1], KIND)
    assert written(spark, repeated) == {1: [(2, [("user", f"t{k}") for k in range(3)])]}
    assert C.unplaced(spark, spark.createDataFrame([], KIND)).count() == 0


def test_no_text_can_hold_a_control_string(spark):
    for text in ODD:
        df = spark.createDataFrame([(text or "",)], "t string")
        e = df.select(C.escaped(F.col("t")).alias("e")).withColumn("u", C.unescaped(F.col("e"))).first()
        assert e.u == (text or "") and "<" not in e.e and "#" not in e.e


def test_empty_table(spark):
    assert written(spark, spark.createDataFrame([], KIND)) == {}


def test_digest_of_a_long_conversation(spark):
    rows = [(7, k, ["user", "assistant"][k % 2], f"<{k}>&" * 30, 0) for k in range(300)]
    given = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, x int")
    got = written(spark, C.chain(given))[7][0][1]
    assert hashlib.sha256(repr(got).encode()).hexdigest() == hashlib.sha256(repr([(r[2], r[3]) for r in rows]).encode()).hexdigest()
