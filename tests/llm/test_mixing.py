import random

import pytest

from plinth.llm import mixing
from tests.llm import brute

SCHEMA = "doc_id long, text string, source string, size string, _hash int"


def check(spark, rows):
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + len(brute.words(text))
    targets = brute.mix_targets(sizes) if rows else {}
    taken = {}
    for r in got:
        assert r["size"] == len(brute.words(r["text"])) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert r["taken"] in (0, r["size"], 2 * r["size"]) and r["taken"] == r["size"] * r["copies"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    return got, targets, taken


def test_targets_and_nearness(spark):
    r = random.Random(3)
    rows = [(i, "w " * r.randint(0, 40), f"s{i % 7}" if i % 3 else "s0", "x", 1) for i in range(900)]
    got, targets, taken = check(spark, rows)
    assert all(abs(taken[s] - targets[s]) <= 40 for s in targets)
    again = mixing.mix(spark.createDataFrame(rows[::-1], SCHEMA)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in got) == sorted((r["doc_id"], r["taken"]) for r in again)


def test_nulls_repeats_and_odd_names(spark):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "a b", None, "q", 2), (2, "a\u00a0b c", "é", "q", 2), (3, "", "Z", "q", 2), (4, "x " * 5, "a", "q", 2), (4, "x " * 5, "a", "q", 2)]
    got, targets, taken = check(spark, rows)
    assert {r["_hash"] for r in got} == {None, 2}


def test_empty_table(spark):
    assert check(spark, [])[0] == []


def test_one_source_takes_one_and_a_half(spark):
    rows = [(i, "a b c", "s", "", 0) for i in range(100)]
    _, targets, taken = check(spark, rows)
    assert targets == {"s": 450} and taken == {"s": 450}


def test_more_sources_than_a_broadcast_takes(spark, monkeypatch):
    from plinth.llm import store

    monkeypatch.setattr(store, "BROADCAST_ROWS", 3)
    rows = [(i, "w " * (i % 9), f"s{i % 11}", "", 0) for i in range(200)]
    check(spark, rows)
