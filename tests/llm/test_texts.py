import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer, models, normalizers

from plinth.llm import licences, packing, quality, queries, tokencount
from tests.llm import brute

ODD = [None, "", " \n\t", "a", "a b c a b c", "x\ny\nx\n \n \nx", "#*$%&|<> é b", "w " * 3000, "a b " * 40, "\x1c\x85 x", "日本 " * 60, "one two three four " * 20]


def test_quality_counts(spark):
    rows = [(i, t, "en" if i % 2 else None, 1, "k") for i, t in enumerate(ODD)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words int, kept string")
    got = quality.score(df).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute.quality_base(ODD[r["doc_id"]])
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and quality.keep_good(df.limit(0)).collect() == []
    assert quality.score(df.limit(0)).collect() == []


def test_repeated_words_both_ways():
    r = random.Random(6)
    for _ in range(200):
        texts = [[r.choice("abcdefgh") for _ in range(r.randint(0, 30))] for _ in range(r.randint(1, 4))]
        ids = np.array([ord(x) - 97 for w in texts for x in w], np.int64)
        of = np.repeat(np.arange(len(texts)), list(map(len, texts)))
        want = [brute.quality_base(" ".join(w))[4] for w in texts]
        for distinct in (8, 1 << 21, 1 << 40):
            assert quality.repeated_words(ids, of, distinct, len(texts)).tolist() == want


def test_verdicts_against_plain_sums(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    docs = [(d["doc_id"], d["text"], d["lang"]) for d in docs] + [(-1, docs[0]["text"], None), (-2, "#!" * 300 + " x" * 60, None), (-3, docs[1]["text"], "xx"), (-4, None, "de")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    want = brute.divergence([d[1] for d in docs], [d[2] for d in docs], quality.COMMON)
    for r in quality.score(df).collect():
        chars, words, kept = want[[d[0] for d in docs].index(r["doc_id"])]
        assert r["chars_apart"] == (None if chars is None else pytest.approx(chars, abs=1e-9))
        assert r["words_apart"] == (None if words is None else pytest.approx(words, abs=1e-9))
        assert r["kept"] == kept
    assert {r["doc_id"] for r in quality.keep_good(df).collect()} == {d[0] for d, (_, _, k) in zip(docs, want) if k}


def test_every_language_is_judged(spark, sf):
    for r in queries.op3_quality_rules(spark, sf).collect():
        assert (r["words_apart"] is None) == (r["n_words"] < 50) and (r["chars_apart"] is None) == (r["word_chars"] < 200)


def test_good_documents_stay_and_junk_goes(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in queries.op3_quality_rules(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    good = [got[x["doc_id"]] for x in labels if x["quality"] == 1]
    bad = [got[x["doc_id"]] for x in labels if x["quality"] == 0]
    assert all(r["kept"] for r in good if not r["base_failed"])
    assert sum(not r["kept"] for r in bad) >= 0.8 * len(bad)
    for doc in spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id < 200").collect():
        r = got[doc["doc_id"]]
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == brute.quality_base(doc["text"])


def test_junk_that_passes_the_base_rules_goes(spark):
    sf = "/root/testdata/sf0.1"
    scored = queries.op3_quality_rules(spark, sf).filter("not base_failed").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    good, bad = (scored.filter(f"quality = {q}").select("n_words", "kept").collect() for q in (1, 0))
    short = [r for r in bad if r["n_words"] < 100]
    assert len(bad) > 200 and sum(not r["kept"] for r in bad) >= 0.98 * len(bad)
    assert len(short) > 20 and sum(not r["kept"] for r in short) >= 0.95 * len(short)
    assert sum(r["kept"] for r in good) >= 0.999 * len(good)


def test_references_leave_junk_out(spark):
    r = random.Random(3)
    common = quality.COMMON["en"].split()
    rows = [(i, " ".join(r.choice(common) if r.random() < 0.5 else f"word{''.join(r.choices('abcdefgh', k=4))}" for _ in range(300)), "en") for i in range(60)]
    rows += [(100 + i, " ".join(f"#{(i + k) % 97}$ %{k}&" for k in range(60)), "en") for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    measured = quality.measure(df, keep=["doc_id"])
    (ref,) = quality.references(measured).collect()
    assert ref["ref_docs"] == 60 and ref["ref_chars"][6] == 0
    assert {r["doc_id"] for r in quality.keep_good(df).collect()} == {r["doc_id"] for r in quality.score(df).filter("kept").collect()} == set(range(60))


def test_plan_is_best_fit():
    r = random.Random(7)
    for _ in range(60):
        capacity = r.choice([7, 16, 50])
        lengths = [r.randint(1, capacity) for _ in range(r.randint(0, 120))]
        histogram = {n: lengths.count(n) for n in set(lengths)}
        rules, bins = packing.plan(histogram, capacity)
        filled = {}
        for rule in rules:
            for i in range(rule.pieces):
                at = rule.bin + i // rule.each
                filled.setdefault(at, []).append((rule.offset + i % rule.each * rule.length, rule.length))
        assert len(filled) == bins
        for parts in filled.values():
            end = 0
            for offset, n in sorted(parts):
                assert offset == end
                end += n
            assert end <= capacity
        assert sorted(capacity - sum(n for _, n in p) for p in filled.values()) == brute.best_fit(lengths, capacity)
        assert sorted(n for p in filled.values() for _, n in p) == sorted(lengths)
    with pytest.raises(ValueError):
        packing.plan({9: 1}, 8)


def test_packing_of_odd_texts(spark):
    texts = [*ODD, "<|endoftext|> <|ENDOFTEXT|> don't stop. É.é İ 1２ " * 400, "a" * 20_000]
    rows = [(i, t, 1, "s") for i, t in enumerate(texts)] + [(0, None, 1, "s"), (None, "a b", 1, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int, sequence_id string")
    packed = packing.pack(df, queries.WORD_TOKENIZER)
    got = packed.collect()
    whole = Tokenizer.from_file(queries.WORD_TOKENIZER)
    for i, t in enumerate(texts):
        mine = sorted((r for r in got if r["doc_id"] == i), key=lambda r: (r["piece"], r["sequence_id"]))
        ids = np.array(whole.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
        if i:
            assert b"".join(bytes(r["tokens"]) for r in mine) == ids and [r["start"] for r in mine] == list(range(0, len(ids) // 4, 2048))
        else:
            assert [bytes(r["tokens"]) for r in mine] == [ids, ids]
    seqs = packing.sequences(packed).collect()
    assert max(s["length"] for s in seqs) <= 2048 and sum(s["length"] for s in seqs) == sum(r["length"] for r in got)
    assert packing.pack(df.limit(0), queries.WORD_TOKENIZER).collect() == []


def test_packing_query(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    whole = Tokenizer.from_file(queries.WORD_TOKENIZER)
    got = queries.op4_best_fit_packing(spark, sf).collect()
    by_seq = {}
    for r in got:
        ids = whole.encode(docs[r["doc_id"]], add_special_tokens=False).ids + [0]
        part = ids[r["start"] : r["start"] + r["length"]]
        assert r["start"] == 2048 * r["piece"] and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_seq.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:i]) for i in range(len(parts))]
    lengths = [r["length"] for r in got]
    assert len(by_seq) == len(brute.best_fit(lengths, 2048))


@pytest.fixture(scope="module")
def unigram():
    vocab = tokencount.vocabulary(queries.PIECES)
    tok = Tokenizer(models.Unigram(vocab, 0, True))
    tok.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    return tokencount.Counter(vocab), tok


def test_counts_equal_the_tokenizer(unigram):
    own, tok = unigram
    r = random.Random(9)
    parts = ["a", "the", " ", "  ", "é", "☃", "<unk>", "<s>", "日", "\n", "▁", "<0x0A>", "ing", "𝔘", "\x00", "</s>"]
    for _ in range(1500):
        s = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        assert own.count(s) == len(tok.encode(s, add_special_tokens=False).ids), s


def test_counts_of_the_table(spark, sf, unigram):
    _, tok = unigram
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op8_token_counts(spark, sf).collect():
        assert r["n_tokens"] == len(tok.encode(docs[r["doc_id"]], add_special_tokens=False).ids)
    df = spark.createDataFrame([(1, None, 5), (1, None, 5), (None, "", 5), (2, "a " * 50_000, 5)], "doc_id long, text string, n_tokens int")
    got = tokencount.count_tokens(df, queries.PIECES).collect()
    assert sorted((r["n_tokens"] for r in got))[:3] == [0, 0, 0]
    assert tokencount.count_tokens(df.limit(0), queries.PIECES).collect() == []


def test_ties_and_unknown_runs():
    # a, b, ab: of equal scores the earliest start wins; no bytes, so unknown characters in a row are one piece
    own = tokencount.Counter([("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", -1.0)])
    tok = Tokenizer(models.Unigram([("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", -1.0)], 0, False))
    for s in ("▁ab", "▁a☃☃b", "▁☃ab☃", "▁abab", "▁<unk>☃a"):
        assert own[s] == len(tok.encode(s, add_special_tokens=False).ids), s


MIT = [licences.SENTENCES[n] for n in ("mit-grant", "mit-notice", "mit-as-is")]


@pytest.mark.parametrize(
    "text, want",
    [
        (None, []), ("", []), ("no licence here", []),
        ("Foo. Released under the MIT License.", [("MIT", "mit-line")]),
        ("foo\nLICENSED UNDER CC BY-NC 4.0.\nbar", [("CC-BY-NC-4.0", "cc-by-nc-line")]),
        ("Licensed under CC BY-NC-SA 4.0.", [("CC-BY-NC-SA-4.0", "cc-by-nc-sa-line")]),
        ("Licensed under CC BY-NC-XX 4.0.", []),
        ("\n".join([MIT[0], *(f"Note {i} says so." for i in range(30)), MIT[1], "1.", "2.", MIT[2]]), [("MIT", "mit-text")]),
        (MIT[0] + "\nx.\n" + MIT[0] + "\n" + MIT[1], [("MIT", "mit-grant-notice")]),
        (licences.SENTENCES["gpl2-free"] + " " + licences.SENTENCES["gpl-hope"] + "\n\n" + licences.SENTENCES["gpl-details"], [("GPL-2.0-or-later", "gpl-2-header")]),
        (licences.SENTENCES["lgpl21-free"], [("LGPL-2.1-or-later", "lgpl-21-grant")]),
        (licences.SENTENCES["agpl3-free"], [("AGPL-3.0-or-later", "agpl-3-grant")]),
        (licences.SENTENCES["zlib-as-is"] + "\nIn no event.\n" + licences.SENTENCES["zlib-grant"], [("Zlib", "zlib-text")]),
        ("We are not Released under the MIT License.", []),
        ("\n\n".join(MIT), [("MIT", "mit-text")]),
        (" ".join(MIT).replace("software and", "software\n  and"), [("MIT", "mit-text")]),
        (MIT[1] + "\n" + MIT[0], []),
        (MIT[0] + "\nCopyright X.\n" + MIT[1], [("MIT", "mit-grant-notice")]),
        ("This work is licensed under the GNU General Public License, version 3.\nLicensed under the Apache License, Version 2.0.", [("GPL-3.0-only", "gpl-3-line"), ("Apache-2.0", "apache-line")]),
        ("\n".join(["1. " + licences.SENTENCES["bsd-source"], "2. " + licences.SENTENCES["bsd-binary"]]), []),
        ("\n".join([licences.SENTENCES["bsd-grant"], "1. " + licences.SENTENCES["bsd-source"], "* " + licences.SENTENCES["bsd-binary"]]), [("BSD-2-Clause", "bsd-2-text")]),
        ("\n".join([licences.SENTENCES["bsd-grant"], "1. " + licences.SENTENCES["bsd-source"], "2. " + licences.SENTENCES["bsd-binary"], "3. " + licences.SENTENCES["bsd-names"]]), [("BSD-3-Clause", "bsd-3-text")]),
    ],
)
def test_licences(text, want):
    assert [m[:2] for m in licences.BOOK.matches(text)] == want


def test_licence_places_and_table(spark, sf):
    text = "é x.\nReleased under the MIT License.\nend"
    df = spark.createDataFrame([(1, text, "m"), (1, text, "m"), (None, None, None), (2, "a. " * 60_000, None)], "doc_id long, text string, matches string")
    got = licences.scan(df).collect()
    assert len(got) == 4
    for r in got:
        if r["doc_id"] == 1:
            assert text[r["matches"][0]["start"] : r["matches"][0]["end"]] == "Released under the MIT License."
        else:
            assert r["matches"] == []
    assert licences.scan(df.limit(0)).collect() == []
    lines = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT", "General Public License, version 3.": "GPL-3.0-only"}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op9_license_scan(spark, sf).collect():
        want = {name for line, name in lines.items() if any(x.endswith(line) for x in docs[r["doc_id"]].split("\n"))}
        assert set(filter(None, r["licences"].split(","))) == want
