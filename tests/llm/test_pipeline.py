import corpus_pipeline
from plinth.llm import quality, queries
from tests.llm import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    verdicts = {r["doc_id"]: r["kept"] for r in queries.op3_quality_rules(spark, sf).collect()}
    steps = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        steps.append(docs)
    good, once, mixed, packed = steps
    assert good.columns == once.columns == mixed.columns == COLUMNS
    assert {r["doc_id"] for r in good.collect()} == {i for i, k in verdicts.items() if k}
    kept = sorted(good.collect(), key=lambda r: r["doc_id"])
    _, links = brute.near([r["text"] for r in kept], 80)
    assert {r["doc_id"] for r in once.collect()} == set(brute.least_ids([r["doc_id"] for r in kept], links))
    sizes = {}
    for r in once.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(brute.words(r["text"]))
    targets, taken = brute.mix_targets(sizes), {}
    for r in mixed.collect():
        taken[r["source"]] = taken.get(r["source"], 0) + len(brute.words(r["text"]))
    longest = max(len(brute.words(r["text"])) for r in once.collect())
    assert all(abs(taken.get(s, 0) - targets[s]) <= longest for s in targets)
    places = {}
    for r in packed.collect():
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sum(r["piece"] == 0 for r in packed.collect()) == mixed.count()
    assert all(sum(n for _, n in p) <= 2048 for p in places.values())
    assert corpus_pipeline.run(spark, sf).count() == packed.count()
    assert corpus_pipeline.ORACLE_SQL is None


def test_odd_rows(spark, sf, tmp_path):
    """Nulls in every column, repeats, ties, a very long text, columns whose names clash; each stage against its operator's rule."""
    good = quality.keep_good(spark.read.parquet(f"{sf}/documents.parquet").filter("lang = 'en' and n_chars between 1500 and 4000")).orderBy("doc_id").collect()
    base, long = good[0]["text"], "\n".join(r["text"] for r in good[1:40])
    near = " ".join(["other", *base.split()[1:]])
    rows = [(1, base, "en", "a", 9), (1, base, "en", "a", 9), (2, near, "en", "b", None), (3, base, None, "b", 1), (4, long, "en", None, 2)]
    rows += [(5, None, "en", "a", 1), (6, "", "en", "a", 1), (None, long + " end", "en", "c", 3), (None, None, None, None, None)]
    df = spark.createDataFrame([(*r, "k", 7, "l") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, kept string, size int, `__p_lang` string")
    docs, steps = df, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, "").write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        steps.append(docs)
    assert steps[0].columns == steps[1].columns == steps[2].columns == df.columns
    ids = lambda d: sorted((r["doc_id"] for r in d.collect()), key=str)
    good = steps[0].collect()
    assert len(good) == 6 and all(r["text"] for r in good) and all(r["kept"] == "k" and r["size"] == 7 and r["__p_lang"] == "l" for r in good)
    _, links = brute.near([r["text"] for r in good], 80)
    assert len(links) == 7 and ids(steps[1]) == [1, 4]
    assert set(ids(steps[2])) <= {1, 4} and steps[3].filter("piece = 0").count() == steps[2].count()


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").collect() == []
