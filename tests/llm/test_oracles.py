"""The registered queries against their SQL, and against plain versions where SQL has no words for them."""

import math
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from plinth.llm import embedding_dedup, mixing, queries, sharding
from tests.llm import brute
from tests.oracle import agree


@pytest.mark.parametrize("name", sorted(set(queries.ORACLE_SQL) - {"op7_chat_format"}))
def test_agrees_with_sql(spark, sf, name):
    agree(queries.QUERIES[name](spark, sf), queries.ORACLE_SQL[name], sf)


def planted(r, n, dims, low, high):
    """n pairs of vectors whose cosines lie between low and high, evenly."""
    a = r.standard_normal((n, dims))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = r.standard_normal((n, dims))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    c = np.linspace(low, high, n)[:, None]
    return a, c * a + np.sqrt(1 - c * c) * b


def test_op1_over_a_table_that_has_links(spark, sf, tmp_path):
    """Recall of the query near the bound, by its SQL on the same table."""
    r = np.random.default_rng(12)
    a, b = planted(r, 400, 64, 0.88, 0.93)
    rows = [*a, *b, *r.standard_normal((1200, 64)), *([a[0]] * 5)]
    table = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)] + [(9000, None), (9001, [0.0] * 64), (9002, [None] * 64)]
    spark.createDataFrame(table, "vec_id long, embedding array<float>").coalesce(1).write.parquet(str(tmp_path / "t"))
    for name in "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split():
        (tmp_path / f"{name}.parquet").symlink_to(f"{sf}/{name}.parquet")
    (tmp_path / "embeddings.parquet").symlink_to(next((tmp_path / "t").glob("part-*.parquet")))
    agree(queries.op1_embedding_near_dedup(spark, str(tmp_path)), queries.ORACLE_SQL["op1_embedding_near_dedup"], str(tmp_path))


def test_sketches_lose_no_links():
    r = np.random.default_rng(3)
    for dims in (16, 64, 300):
        a, b = planted(r, 3000, dims, 0.9, 0.9)
        one, other = ([x.tobytes() for x in embedding_dedup.signs(v)] for v in (a, b))
        assert embedding_dedup.alike(one, other).all()
        assert embedding_dedup.alike(one[1:], other[:-1]).mean() < 0.01 or dims == 16
        assert (embedding_dedup.alike_among(other)(0) == embedding_dedup.alike([other[0]] * 3000, other)).all()


def test_one_sum_decides_at_the_bound():
    r = np.random.default_rng(5)
    a, b = planted(r, 300, 64, 0.9, 0.9)
    rows = [x.tobytes() for x in (*a, *b)]
    units = embedding_dedup.unit(rows)
    hit = embedding_dedup.cosines_reach(units, units)
    for i in range(0, 600, 7):
        assert (hit[i] == embedding_dedup.among(rows)(i)).all() and (hit[i] == embedding_dedup.linked([rows[i]] * 600, rows)).all()


def hash64(value, seed):
    if value is None:
        return seed
    data = struct.pack("<q", value) if isinstance(value, int) else value.encode()
    return xxhash.xxh64_intdigest(data, seed=seed)


def test_op2_takes_by_threshold(spark, sf):
    """In each source the documents taken once more are those of the least hashes, as many as come nearest to the target."""
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    by_source = {}
    for r in queries.op2_mix_sources(spark, sf).collect():
        d = docs[r["doc_id"]]
        key = hash64(d["text"], hash64(r["doc_id"], 42)) >> (64 - mixing.HASH_BITS)
        assert r["size"] == len(brute.words(d["text"]))
        by_source.setdefault(d["source"], []).append((key, r["size"], r["taken"], r["target"], r["source_size"]))
    assert len(by_source) > 1
    for rows in by_source.values():
        rows.sort()
        target, size = rows[0][3:]
        assert size == sum(x[1] for x in rows)
        base = math.floor(target / size)
        more = [taken - base * n for _, n, taken, _, _ in rows]
        worded = [(n, m) for (_, n, *_), m in zip(rows, more) if n]
        cut = sum(m > 0 for _, m in worded)
        assert [m for _, m in worded] == [n for n, _ in worded[:cut]] + [0] * (len(worded) - cut)
        need, got = target - base * size, sum(n for n, _ in worded[:cut])
        for neighbour in (worded[cut - 1][0] * -1 if cut else 0, worded[cut][0] if cut < len(worded) else 0):
            assert abs(got - need) <= abs(got + neighbour - need) + 1e-6


def test_op10_draws(spark, sf):
    """Shards recomputed: on each level the child with the least -ln(u) / weight."""

    def descend(node, path, key):
        if not isinstance(node, dict):
            return node
        draws = []
        for i, (name, child) in enumerate(node.items()):
            u = ((hash64(key, hash64(f"{path}/{name}", 42)) >> 11) + 0.5) / (1 << 53)
            draws.append((-math.log(u) / sharding.weight_of(child), i, name))
        name = min(draws)[2] if len(draws) > 1 else draws[0][2]
        return name if not isinstance(node[name], dict) else descend(node[name], f"{path}/{name}", key)

    grown = sharding.grow(sharding.EIGHT, 8)
    for r in queries.op10_hash_tree_shards(spark, sf).collect():
        assert r["shard"] == descend(sharding.EIGHT, "", r["doc_id"]) and r["grown_shard"] == descend(grown, "", r["doc_id"])


def test_op9_spans_and_rules(spark, sf):
    """Every known line of the table stands at the span that the query gives, by its rule, and in order."""
    lines = {"Licensed under CC BY-NC 4.0.": "cc-by-nc-line", "Licensed under the Apache License, Version 2.0.": "apache-line", "Released under the MIT License.": "mit-line", "This work is licensed under the GNU General Public License, version 3.": "gpl-3-line"}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = 0
    for r in queries.op9_license_scan(spark, sf).collect():
        text = docs[r["doc_id"]]
        spans = [tuple(map(int, s.split("-"))) for s in r["spans"].split(",") if s]
        assert spans == sorted(spans) and r["n_matches"] == len(spans) == len([x for x in r["rules"].split(",") if x])
        for (start, end), rule in zip(spans, r["rules"].split(",")):
            assert lines[text[start:end]] == rule
            found += 1
        assert len(spans) == sum(text.count(line) for line in lines)
    assert found > 0
