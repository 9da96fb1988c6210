import duckdb
from pyspark.sql import functions as F

from recordforge.llm import chat_preferences as C

TURNS = "conv_id bigint, turn bigint, role string, text string"


def pair(spark, chosen, rejected):
    turns = "array<struct<turn:bigint,role:string,text:string>>"
    df = spark.createDataFrame([(1, chosen, rejected)], f"pair_id int, chosen {turns}, rejected {turns}")
    return C.format_pairs(df).collect()[0]


def learnt(text, spans):
    return [text[int(a) : int(a) + int(n)] for a, n in (s.split(":") for s in spans.split(",") if s)]


def test_common_prefix_is_the_prompt(spark):
    head = [(0, "system", "Be kind."), (1, "user", "Hi é😀")]
    r = pair(spark, [*head, (2, "assistant", "Hello!"), (3, "user", "More")], [*head, (2, "assistant", "Go away."), (3, "assistant", "Now")])
    assert r.n_prefix_turns == 2
    assert r.prompt == "<|system|>\nBe kind.<|end|>\n<|user|>\nHi é😀<|end|>\n"
    assert r.chosen == "<|assistant|>\nHello!<|end|>\n<|user|>\nMore<|end|>\n"
    assert learnt(r.chosen, r.chosen_mask) == ["Hello!<|end|>"]
    assert learnt(r.rejected, r.rejected_mask) == ["Go away.<|end|>", "Now<|end|>"]


def test_prefix_needs_role_and_text(spark):
    assert pair(spark, [(0, "user", "a")], [(0, "system", "a")]).n_prefix_turns == 0
    same = [(0, "user", "a"), (1, "assistant", "b")]
    r = pair(spark, same, same)
    assert (r.n_prefix_turns, r.chosen, r.chosen_mask) == (2, "", "")
    r = pair(spark, same, same[:1])
    assert r.n_prefix_turns == 1 and r.rejected == "" and learnt(r.chosen, r.chosen_mask) == ["b<|end|>"]
    assert pair(spark, same, None).n_prefix_turns == 0 and pair(spark, [], []).prompt == ""


def rows():
    out = [(c, t, "user" if t % 2 == 0 else "assistant", f"text {c} {t} é") for c in range(12) if c != 7 for t in range(2 + c % 4)]
    out += [(20, 0, "user", "no answer"), (21, 0, None, None), (21, 1, "assistant", None), (21, 1, "assistant", None)]
    out += [(30, None, "assistant", ""), (31, 0, "assistant", "same"), (30, 1, "user", "x" * 100_000), (None, 0, "user", "lost")]
    return out


def test_query_equals_sql(spark):
    df = spark.createDataFrame(rows(), TURNS).repartition(3)
    got = C.format_pairs(C.swapped_answers(df.selectExpr("*", "1 AS turns", "2 AS last", "3 AS pair_id")))
    con = duckdb.connect()
    con.register("conversations", df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    want = con.sql(C.ORACLE)
    assert sorted(map(repr, (tuple(r) for r in got.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_turns_without_an_id_are_conversations_of_their_own(spark):
    lost = [(None, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(50)] + [(None, 3, "assistant", "t3")]
    df = spark.createDataFrame(rows() + lost, TURNS).repartition(4)
    got = [r for r in C.format_pairs(C.swapped_answers(df)).collect() if r.pair_id is None]
    assert len(got) == 52 and all(r.rejected == "" for r in got)
    assert sorted(r.chosen for r in got if r.chosen) == sorted(f"<|assistant|>\n{t}<|end|>\n" for _, _, role, t in lost if role == "assistant")
    con = duckdb.connect()
    con.register("conversations", df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    want = con.sql(C.ORACLE)
    out = C.format_pairs(C.swapped_answers(df)).select(*want.columns).collect()
    assert sorted(map(repr, map(tuple, out))) == sorted(map(repr, want.fetchall()))


def test_empty_table_and_native_plan(spark):
    empty = spark.createDataFrame([], TURNS)
    out = C.format_pairs(C.swapped_answers(empty))
    assert out.collect() == []
    plan = C.format_pairs(C.swapped_answers(spark.createDataFrame(rows(), TURNS).withColumn("z", F.lit(1))))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
