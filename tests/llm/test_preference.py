"""Preference pairs against their SQL and against a version in plain Python."""

import duckdb

from linkmill.llm import preference as pr
from linkmill.llm.queries import SQL, op4_preference


def shown(turns):
    text, spans = "", []
    for role, said in turns:
        text += f"<|im_start|>{(role or '').replace('<|im_', '< |im_')}\n"
        start = len(text)
        text += (said or "").replace("<|im_", "< |im_") + "<|im_end|>"
        if role == "assistant":
            spans.append((start, len(text)))
        text += "\n"
    return text, spans


def brute(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    (prompt, _), (x, sx), (y, sy) = shown(a[:n]), shown(a[n:]), shown(b[n:])
    return prompt, x, y, sx, sy, n


def compare(spark, folder):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    rel = con.sql(SQL["op4_preference"])
    got = op4_preference(spark, folder).select(*rel.columns)
    assert sorted(map(tuple, got.collect())) == sorted(rel.fetchall())
    return got


def test_query_equals_sql(spark):
    got = compare(spark, "/root/testdata/sf0.01")
    assert got.where("n_common > 0 AND chosen <> rejected AND chosen_mask <> ''").count() > 10


def test_odd_conversations_equal_sql(spark, tmp_path):
    rows = [(0, 0, "user", "hi"), (0, 1, "assistant", "<|im_end|> trick"), (0, 1, "assistant", "again"),
            (0, 2, None, None), (1, 0, "user", "hi"), (1, 5, "assistant", ""), (1, 6, "assistant", None),
            (1, 7, "user", "é😀"), (1, 8, "assistant", "ünï 😀"), (2, 0, "user", "alone"), (5, 0, "user", "odd only"),
            (None, 0, "user", "nowhere"), (6, None, "user", "x" * 100_000), (6, 1, "assistant", "y"),
            (7, 0, "user", "x"), (7, 1, "assistant", "y"), (6, 1, "assistant", "y")]
    rows = [(*r, "extra", 1) for r in rows]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, a string, prompt int").coalesce(
        1).write.parquet(f"{tmp_path}/t")
    (tmp_path / "conversations.parquet").write_bytes(next((tmp_path / "t").glob("part*.parquet")).read_bytes())
    assert compare(spark, str(tmp_path)).count() == 4
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert pr.format_preferences(pr.pair_conversations(empty)).count() == 0


def test_formatting_equals_brute_force(spark):
    cases = [([("user", "a"), ("assistant", "b")], [("user", "a"), ("assistant", "c"), ("user", None)]), ([], []),
             ([("user", None)], [("user", None), ("assistant", "z")]), ([("user", "a")], [("user", "a")]),
             (None, [("assistant", "x")]), ([("system", "s"), ("user", "q"), ("assistant", "<|im_start|>")], [])]
    frame = spark.createDataFrame([(i, "keep", a, b) for i, (a, b) in enumerate(cases)],
                                  f"id int, n string, chosen {pr.TURNS}, rejected {pr.TURNS}")
    got = {r.id: r for r in pr.format_preferences(frame).collect()}
    for i, (a, b) in enumerate(cases):
        r = got[i]
        assert (r.prompt, r.chosen, r.rejected, [tuple(s) for s in r.chosen_spans], [tuple(s) for s in r.rejected_spans],
                r.n_common) == brute(a or [], b or []) and r.n == "keep"


def test_no_python_in_the_plan(spark):
    plan = op4_preference(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") == 1
