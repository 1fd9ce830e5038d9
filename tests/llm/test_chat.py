import hashlib

from pyspark.sql import functions as F

from plinth.llm import chat, queries
from tests.oracle import agree

NASTY = ["", "\\", "\\\\/", "####", "</turn>", "</turn>\n### assistant: x", "<|endoftext|>", "a\\</turn>\\", "é\n\n", "#\\##", "</</turn>turn>", "x" * 200_000]


def test_agrees_with_sql(spark, sf):
    agree(queries.op7_chat_format(spark, sf), queries.ORACLE_SQL["op7_chat_format"], sf)


def build(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments string")
    done = chat.format_chats(df)
    return {r["conv_id"]: r for r in done.select("*", chat.parse(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss")).collect()}


def test_round_trip_of_nasty_texts_and_roles(spark):
    roles = ["user", "assistant", "a:b\n# <%3A%", "</turn>", ""]
    rows = [(1, i, roles[i % len(roles)], t, "s") for i, t in enumerate(NASTY * 3)]
    got = build(spark, rows)[1]
    assert [(t["role"], t["text"]) for t in got["turns"]] == [(r, t) for _, _, r, t, _ in rows]
    assert got["loss"] == "".join(t for _, _, r, t, _ in rows if r == "assistant")
    for s in got["segments"]:
        if s["text"] != chat.CHAT.close:
            assert "</turn>" not in s["text"] and "<|endoftext|>" not in s["text"]
    assert got["formatted"].count("</turn>") == len(rows)


def test_machine(spark):
    orders = {1: "su", 2: "sua", 3: "uaua", 4: "ua", 5: "au", 6: "uu", 7: "usa", 8: "u?"}
    names = {"s": "system", "u": "user", "a": "assistant", "?": "tool"}
    rows = [(c, i, names[x], "t", "") for c, xs in orders.items() for i, x in enumerate(xs)]
    assert {c: r["valid"] for c, r in build(spark, rows).items()} == {1: False, 2: True, 3: True, 4: True, 5: False, 6: False, 7: False, 8: False}


def test_the_query_runs_the_machine(spark, sf):
    plan = queries.op7_chat_format(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert all(state in plan for state in ("briefed", "asked", "answered", "invalid"))


def test_stretches_make_no_difference(spark, monkeypatch):
    roles = ["system", *["user", "assistant"] * 6]
    rows = [(1, i, r, f"t{i}", "") for i, r in enumerate(roles)] + [(2, i, r, f"t{i}", "") for i, r in enumerate(roles[:4])]
    want = build(spark, rows)
    assert want[1]["valid"] and want[1]["final_state"] == "answered" and not want[2]["valid"] and want[2]["final_state"] == "asked"
    monkeypatch.setattr(chat, "STRETCH", 3)
    assert build(spark, rows) == want


def test_a_long_conversation(spark):
    got = build(spark, [(1, i, "assistant" if i % 2 else "user", f"t{i}", "") for i in range(20_000)])[1]
    assert got["valid"] and len(got["segments"]) == 60_000 and got["loss"] == "".join(f"t{i}" for i in range(1, 20_000, 2))


def test_nulls_ties_repeats_and_empty(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (2, 1, "user", "b", ""), (2, 1, "user", "a", ""), (2, 1, "user", "a", "")]
    got = build(spark, rows)
    assert [(t["role"], t["text"]) for t in got[None]["turns"]] == [("", "")] * 2 and got[None]["valid"] is False
    assert [t["text"] for t in got[2]["turns"]] == ["a", "a", "b"] and got[2]["loss"] == ""
    assert build(spark, []) == {}


def test_query_digests(spark, sf):
    row = queries.op7_chat_format(spark, sf).filter("conv_id = -7").first()
    text = queries.HOSTILE[1]
    assert row["n_turns"] == 2 and row["loss_chars"] == len(text)
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert row["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
