import random

import numpy as np
import pytest

from plinth.llm import embedding_dedup, linking, minhash, queries, store
from tests.llm import brute

DOCS = "doc_id long, text string, node string, __p_id int"


def compare(spark, rows, percent=85):
    got = minhash.near_copies(spark.createDataFrame(rows, DOCS), percent=percent).collect()
    sets, links = brute.near([r[1] for r in rows], percent)
    least = brute.least_ids([r[0] for r in rows], links)
    want = sorted((r[0], len(s), c if s else r[0], c == r[0] if s else True) for r, s, c in zip(rows, sets, least) if r[0] is not None)
    assert sorted(tuple(r[c] for c in ("doc_id", "n_shingles", "component_id", "kept")) for r in got if r["doc_id"] is not None) == want
    assert len(got) == len(rows)
    return got, links


def vary(r, words, n):
    out = list(words)
    for _ in range(n):
        out[r.randrange(len(out))] = f"v{r.randrange(10**6)}"
    return " ".join(out)


def test_groups_chains_and_strangers(spark):
    r = random.Random(5)
    rows = []
    for g in range(6):
        base = [f"g{g}w{r.randrange(400)}" for _ in range(r.choice([60, 200, 400]))]
        shared = [f"p{k}" for k in range(50)]
        rows += [(len(rows), vary(r, base, r.randrange(0, 4)), "n", 1) for _ in range(12)]
        step = list(base)
        for _ in range(8):  # a chain whose ends are far apart
            step = vary(r, step, max(1, len(step) // 90)).split()
            rows.append((len(rows), " ".join(step), "n", 1))
        rows += [(len(rows), " ".join(shared + [f"q{r.randrange(10**6)}" for _ in range(30)]), "n", 1) for _ in range(5)]
    _, links = compare(spark, rows)
    _, more = compare(spark, rows, 80)
    assert 50 < len(links) <= len(more)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(9, None, "", 0), (8, "", "", 0), (7, " \n\t", "", 0), (6, "One two", "", 0), (5, "one TWO ", "", 0), (5, "one two", "", 0), (4, "É a b c d", "", 0), (3, "é a b c d", "", 0), (2, long, "", 0), (1, long + " x", "", 0), (1, long + " x", "", 0), (None, "One two", "", 0), (None, None, "", 0)]
    compare(spark, rows)


def test_default_is_80_percent(spark):
    base = [f"w{k}" for k in range(104)]
    rows = [(0, " ".join(base), "", 0), (1, " ".join(f"x{k}" if k in (20, 50) else w for k, w in enumerate(base)), "", 0)]  # 0.82 alike
    assert [r["component_id"] for r in minhash.near_copies(spark.createDataFrame(rows, DOCS)).collect()] == [0, 0]
    assert minhash.keep_one(spark.createDataFrame(rows, DOCS)).count() == 1


def test_tables_too_large_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(store, "BROADCAST_ROWS", 2)
    words = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join([*words, str(i % 3)]), "n", i) for i in range(12)] + [(50, "a b", "n", 1), (50, "a b", "n", 1), (None, "q", "n", 1), (None, "q", "n", 1), (None, None, "n", 1)]
    out = minhash.keep_one(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((str(r["doc_id"]), r["text"] is None) for r in out) == [("0", False), ("50", False), ("None", False), ("None", True)]


def test_bytes_bound_a_broadcast(spark, monkeypatch):
    df = spark.createDataFrame([("x" * 5000, [1.0] * 500)], "a string, b array<double>")
    assert store.is_small(df) and store.is_small(df.limit(0))
    monkeypatch.setattr(store, "BROADCAST_BYTES", 12_000)
    assert not store.is_small(df) and store.is_small(df.select("a"))


def test_tables_of_a_call_are_deleted(spark):
    before = len(store._written)
    minhash.near_copies(spark.createDataFrame([(1, "a b", "", 0)], DOCS))
    assert len(store._written) == before + 1  # the result


def test_empty_tables(spark):
    assert minhash.near_copies(spark.createDataFrame([], DOCS)).collect() == []
    assert minhash.keep_one(spark.createDataFrame([], DOCS)).collect() == []


def test_keep_one(spark):
    text = "a b c d e f g h"
    rows = [(3, text, "n", 1), (2, text.upper(), "m", 2), (2, text.upper(), "m", 2), (7, "z", None, None), (8, None, None, None), (None, "q r s", "k", 1)]
    out = minhash.keep_one(spark.createDataFrame(rows, DOCS))
    assert out.columns == ["doc_id", "text", "node", "__p_id"]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, [(2, text.upper(), "m", 2), (7, "z", None, None), (8, None, None, None), (None, "q r s", "k", 1)]))


def test_query_on_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    sets, links = brute.near([d["text"] for d in docs])
    want = dict(zip([d["doc_id"] for d in docs], brute.least_ids([d["doc_id"] for d in docs], links)))
    got = queries.op5_minhash_near_dedup(spark, sf).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_keep_one_where_ids_do_not_tell(spark):
    words = [f"w{k}" for k in range(200)]
    near = lambda g, k: " ".join([g, *words[:100], f"x{k}", *(g + w for w in words)])
    rows = [(None, near("a", k), "", 0) for k in range(3)] + [(4, near("b", k), "", 0) for k in range(3)] + [(None, near("c", 0), "", 0), (9, near("c", 1), "", 0)]
    assert len(brute.near([x[1] for x in rows])[1]) == 7
    out = minhash.keep_one(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((x["text"][0], x["doc_id"]) for x in out) == [("a", None), ("b", 4), ("c", 9)]


def test_keep_one_at_80(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    rows = [(d["doc_id"], d["text"], "", 0) for d in docs]
    base = [f"w{k}" for k in range(104)]  # 100 shingles; a word changed inside makes 5 others
    for changed in ((), (20,), (20, 50), (20, 50, 80)):  # 0.90, 0.82 and 0.74 from the first
        rows.append((10**6 + len(changed), " ".join(f"x{k}" if k in changed else w for k, w in enumerate(base)), "", 0))
    _, links = brute.near([x[1] for x in rows], 80)
    want = set(brute.least_ids([x[0] for x in rows], links))
    assert len(want) < len(set(brute.least_ids([x[0] for x in rows], brute.near([x[1] for x in rows])[1])))
    got = [x["doc_id"] for x in minhash.keep_one(spark.createDataFrame(rows, DOCS), percent=80).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    with pytest.raises(ValueError):
        minhash.keep_one(spark.createDataFrame(rows, DOCS), percent=70)


def test_minhashes_estimate_similarity():
    r = np.random.default_rng(1)
    errors = []
    for share in (0.3, 0.85):
        a = np.unique(r.integers(0, 1 << 63, 2000).astype(np.uint64))
        n = int(len(a) * 2 * share / (1 + share))
        b = np.unique(np.concatenate((a[r.permutation(len(a))[:n]], r.integers(0, 1 << 63, len(a) - n).astype(np.uint64))))
        j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        errors.append(abs((minhash.minhashes(a) == minhash.minhashes(b)).mean() - j))
    assert max(errors) < 0.2


def test_block_lookup_equals_pairs():
    r = np.random.default_rng(2)
    base = r.integers(0, 1 << 63, 60).astype(np.uint64)
    sets = [np.unique(np.concatenate((base[: r.integers(40, 60)], r.integers(0, 1 << 63, r.integers(0, 8)).astype(np.uint64)))).tobytes() for _ in range(30)]
    row = minhash.among(sets)
    for i in range(30):
        assert (row(i) == minhash.linked([sets[i]] * 30, sets)).all()


def test_components_of_a_long_chain(spark):
    r = random.Random(1)
    order = list(range(400))
    r.shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(299)] + [(order[i], order[300]) for i in range(301, 400)]
    got = {r["node"]: r["component"] for r in linking.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert set(got) == set(order) and {got[x] for x in order[:300]} == {min(order[:300])} and {got[x] for x in order[300:]} == {min(order[300:])}
    assert linking.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_few_links_take_no_rounds(spark, monkeypatch):
    r = random.Random(4)
    links = spark.createDataFrame([(r.randrange(500), r.randrange(500)) for _ in range(300)], "a long, b long").repartition(5)
    written = []
    monkeypatch.setattr(linking, "materialise", lambda df: written.append(df) or store.materialise(df))
    few = sorted(map(tuple, linking.components(links).collect()))
    assert len(written) == 2
    monkeypatch.setattr(linking, "ONE_TASK", 0)
    assert sorted(map(tuple, linking.components(links).collect())) == few


def test_components_of_many_links(spark):
    n = 120_000  # the sum of so many 48-bit hashes passes 63 bits
    links = spark.range(n).selectExpr("3 * id + 1 AS a", "3 * id AS b").unionByName(spark.range(n).selectExpr("3 * id + 2 AS a", "3 * id + 1 AS b"))
    got = linking.components(links)
    assert got.count() == 3 * n
    assert got.filter("component <> node - node % 3").count() == 0


def test_small_blocks_find_what_large_ones_do(spark, monkeypatch):
    monkeypatch.setattr(linking, "BLOCK_NODES", 3)
    monkeypatch.setattr(linking, "SKETCH_BLOCK", 2)
    r = random.Random(8)
    base = [f"w{i}" for i in range(100)]
    compare(spark, [(i, vary(r, base, 2), "", 0) for i in range(40)])


def test_a_group_that_fits_a_block_is_dealt_once(spark, monkeypatch):
    n, main = 1500, 600
    left_over = spark.range(n).selectExpr("0L AS key", "id AS node", f"if(id < {main}, 0, id) AS component", f"id < {main} AS main")
    payloads = spark.range(n).selectExpr("id AS node", "unhex('00') AS payload")
    monkeypatch.setattr(linking, "arrow_stream", lambda df, run, schema: df)
    for flag, block in ((True, linking.SKETCH_BLOCK), (False, linking.BLOCK_NODES)):
        assert linking._blocks(left_over, payloads, None, block, flag).count() == n
    assert linking._blocks(left_over, payloads, None, n - 1, False).count() == 2 * (n - main) + main
    monkeypatch.setattr(linking, "BLOCK_BYTES", n - 1)
    assert linking._blocks(left_over, payloads, None, linking.BLOCK_NODES, False).count() == 2 * (n - main) + main


VECTORS = "vec_id long, embedding array<double>, digest string"


def vectors(spark, rows):
    got = {}
    for r in embedding_dedup.near_vectors(spark.createDataFrame([(i, v, "x") for i, v in rows], VECTORS)).collect():
        got.setdefault(r["vec_id"], []).append((r["n_links"], r["component_id"], r["kept"]))
    return got


def test_vectors_against_all_pairs(spark):
    r = np.random.default_rng(4)
    rows = [r.standard_normal(32) for _ in range(150)]
    for c in range(4):
        centre = r.standard_normal(32)
        rows += [centre + r.standard_normal(32) * 0.2 * k / 10 for k in range(12)]
        rows += [centre * 3] * 5
    x = np.array(rows)
    units = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = units @ units.T >= 0.9
    np.fill_diagonal(hit, False)
    least = brute.least_ids(list(range(len(x))), list(zip(*np.nonzero(hit))))
    got = vectors(spark, [(i, v.tolist()) for i, v in enumerate(rows)])
    assert [got[i][0][0] for i in range(len(x))] == hit.sum(1).tolist()
    assert [got[i][0][1] for i in range(len(x))] == least


def test_odd_vectors(spark):
    nan = float("nan")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [None, 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0, 0.0]), (9, [1e300, 0.0]), (10, [1e-300, 0.0]), (11, [-1.0, 0.0]), (12, [1.0, -0.0]), (12, [1.0, 0.0])]
    got = vectors(spark, rows)
    for i in (1, 2, 3, 4, 5, 6, 8, 11):
        assert got[i] == [(0, i, True)]
    assert got[7] == [(4, 7, True)] and got[9] == [(4, 7, False)] and got[12] == [(4, 7, False)] * 2
    assert vectors(spark, []) == {}


def test_recall_at_the_bound():
    k, tables = embedding_dedup.shape(1000)
    assert 1 - (1 - embedding_dedup.meeting(np.sqrt(0.2)) ** k) ** tables >= 0.995
    assert embedding_dedup.meeting(np.sqrt(0.2)) == pytest.approx(0.8215, abs=1e-3)
