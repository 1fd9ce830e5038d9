import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from plinth.llm import sharding


def test_contract(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    got = sharding.shard_documents(docs).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(got) == len(texts)
    for r in got:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 1, zlib.crc32(data), "key")
        assert 0 <= r["shard"] < 8 and r["grown_shard"] in (r["shard"], 8)
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def shares(spark, tree, n=20_000):
    rows = sharding.place(spark.range(n).withColumn("shard", F.lit("old")), ["id"], tree).collect()
    return {r["id"]: r["shard"] for r in rows}


def test_weights_and_confined_movement(spark):
    tree = {"a": {"k": {0: 1.0, 1: 3.0}, "l": {2: 2.0}}, "b": {"k": {3: 2.0, 4: 0.0}}}
    was = shares(spark, tree)
    counts = Counter(was.values())
    for shard, w in ((0, 1), (1, 3), (2, 2), (3, 2)):
        assert counts[shard] == pytest.approx(20_000 * w / 8, rel=0.1)
    assert 4 not in counts
    # more weight for one shard: rows move into its region, or within it towards its rack
    heavier = {**tree, "a": {"k": {0: 1.0, 1: 5.0}, "l": {2: 2.0}}}
    now = shares(spark, heavier)
    moved = [(was[i], now[i]) for i in was if was[i] != now[i]]
    assert moved and all(to != 3 for _, to in moved)
    grown = shares(spark, sharding.grow(tree, 9))
    assert {(was[i] == grown[i]) or grown[i] == 9 for i in was} == {True}


def test_nulls_repeats_empty_and_clashing_names(spark):
    schema = "doc_id long, text string, shard string, slot int, __p_salt int"
    df = spark.createDataFrame([(None, None, "x", 1, 1), (None, None, "x", 1, 1), (1, "é", "x", 1, 1), (1, "é", "x", 1, 1), (1, "z" * 300_000, "x", 1, 1)], schema)
    got = sharding.shard_documents(df).collect()
    assert sorted(r["size"] for r in got) == [1, 1, 3, 3, 300_001]
    assert len({r["shard"] for r in got if r["doc_id"] == 1}) == 1
    assert sharding.shard_documents(df.limit(0)).collect() == []
    assert sharding.place(df, ["doc_id", "text"], sharding.EIGHT).columns == ["doc_id", "text", "slot", "__p_salt", "shard"]


def test_bad_trees():
    with pytest.raises(ValueError):
        sharding.grow(sharding.EIGHT, 3)
    with pytest.raises(ValueError):
        sharding.shard_of([], {"a": {"k": {0: 0.0}}})
