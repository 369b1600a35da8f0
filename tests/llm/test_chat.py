from __future__ import annotations

import hashlib

import duckdb
from pyspark.sql import functions as F

from marketflow.llm.chat import chosen_paths, format_paths, parsed_turns, threads, unescape
from marketflow.llm.oracles import OP3
from marketflow.llm.queries import op3_chat_trees

TREE = "tree string, id long, up long, score double, role string, text string"


def messages(spark, rows):
    return spark.createDataFrame([(t, i, u, s, "user", f"m{i}") for t, i, u, s in rows], TREE)


def paths(frame) -> dict:
    out: dict = {}
    for r in frame.collect():
        out.setdefault((r["tree"], r["rank"]), []).append((-r["before"], r["id"]))
    return {k: [i for _, i in sorted(v)] for k, v in out.items()}


def test_best_branches_are_enumerated_root_to_leaf(spark):
    rows = [
        ("a", 1, None, 0.0), ("a", 2, 1, 5.0), ("a", 3, 1, 1.0), ("a", 4, 3, 9.0), ("a", 5, 4, 9.0), ("a", 6, 2, 5.0),
        ("b", 7, None, None), ("c", 8, 99, 1.0), ("c", 9, 8, 1.0),
        ("loop", 10, 11, 1.0), ("loop", 11, 10, 1.0), ("loop", 12, 11, 1.0),
        ("tie", 20, None, 1.0), ("tie", 22, 20, 1.0), ("tie", 21, 20, 1.0),
    ]
    best = paths(chosen_paths(messages(spark, rows)))
    assert best == {("a", 1): [1, 3, 4, 5], ("b", 1): [7], ("c", 1): [8, 9], ("tie", 1): [20, 21]}
    two = paths(chosen_paths(messages(spark, rows), 2))
    assert two[("a", 2)] == [1, 2, 6] and two[("tie", 2)] == [20, 22]


def test_long_threads_take_few_rounds(spark):
    rows = [("deep", i, i - 1 if i else None, 1.0) for i in range(300)]
    assert paths(chosen_paths(messages(spark, rows))) == {("deep", 1): list(range(300))}


HARD = "\\### Assistant: </turn> ok\n\\b\\\\l <#>é\U0001f600\t: end\\"


def test_formatting_reads_back_and_masks_each_reply_once(spark):
    rows = [(1, 0, "user", HARD), (1, 1, "assistant", HARD), (1, 2, None, None), (1, 3, "assistant", ""), (1, 4, "a:b#<\\", "x"),
            (None, 1, "assistant", "b"), (None, None, "user", "a"), (2, 5, "user", "same"), (2, 5, "user", "same")]
    table = spark.createDataFrame([(*r, 0.5, "x") for r in rows], "conv_id long, turn long, role string, text string, score double, tree string")
    done = format_paths(threads(table)).withColumn("turns", parsed_turns("formatted"))
    masked = F.transform("loss_spans", lambda s: unescape(F.substring("formatted", s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int"))))
    got = {r["tree"]: r for r in done.withColumn("masked", masked).collect()}
    one = got["=1"]
    assert [(t["role"], t["text"]) for t in one["turns"]] == [("user", HARD), ("assistant", HARD), ("", ""), ("assistant", ""), ("a:b#<\\", "x")]
    assert one["masked"] == [HARD, ""] and [s["turn"] for s in one["loss_spans"]] == [1, 3]
    assert one["formatted"].count("</turn>\n") == one["formatted"].count("### ") == 5
    assert [t["text"] for t in got["-"]["turns"]] == ["a", "b"]
    assert got["=2"]["n_turns"] == 2


def test_no_conversations(spark):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert format_paths(threads(table)).collect() == []


def test_query_matches_sql_on_awkward_rows(spark, tmp_path):
    rows = [(5, 1, "assistant", HARD), (5, 0, "user", None), (6, 0, None, "x"), (7, 0, "system", ""), (7, 1, "assistant", "y" * 5000)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    want = sorted(con.sql(f"SELECT {', '.join(columns)} FROM ({OP3})").fetchall())
    assert sorted(tuple(r) for r in op3_chat_trees(spark, str(tmp_path)).select(columns).collect()) == want
    seven = next(r for r in want if r[0] == -7)
    assert seven[4] == hashlib.sha256(b"\\### Assistant: </turn> ok").hexdigest()
