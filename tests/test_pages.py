import pandas as pd
from pyspark.sql import functions as F

from plinth.functions import batches, html, text
from plinth.operators import crawl, emails, links, practice, profile
from plinth.plans import samples


def test_tree_nests_unclosed_and_hides():
    page = html.parse("<div>a<p>b<b>c</div><script>x</script><noscript>n</noscript><svg>v</svg> d &amp; e<br>f<!-- g -->")
    assert html.Page("<div>a<p>b<b>c</div><noscript>n</noscript> d &amp; e<br>f<!-- g -->").text() == "a b c n d & e f"
    assert page["visible_text"] == "a b c d & e f"


def test_empty_pages():
    for raw in ("", None, "<", "</p>"):
        assert html.parse(raw)["anchors"] == []


def test_deobfuscation_spelled_and_bracketed(spark):
    rows = [("write me at mail1 dot some dot test now", "write me@mail1.some.test now"), ("a [AT] b (dot) test", "a@b.test"), ("look at this", "look at this"), ("x at y dot z at q dot r", "x@y.z at q dot r"), ("jo\u00a0at\u00a0c\u00a0dot\u00a0test", "jo@c.test"), ("\u00e9jo at e dot test", "\u00e9jo at e dot test")]
    got = spark.createDataFrame(rows, "t string, w string").select("t", "w", emails.deobfuscate(F.col("t")).alias("g")).collect()
    for _, want, g in got:
        assert g == want


def test_unique_keeps_first_spelling(spark):
    got = spark.range(1).select(text.unique(F.array(F.lit(" A  b,"), F.lit("a B"), F.lit(""), F.lit(" , "), F.lit("c"))).alias("u")).first()["u"]
    assert got == ["A b", "c"]


def test_empty_profile(spark):
    row = profile.extract(spark.createDataFrame([("PT:1", "https://d.test/1", "")], "source_profile_id string, profile_url string, html string")).first()
    assert row["payment_category"] == "self_pay" and row["availability_status"] == "accepting_new_clients" and row["pt_website_redirect"] == "__unavailable__"
    assert row["first_name"] is None and row["all_specialties"] is None and row["fee_clean"] is None


def test_profile_fields(spark):
    row = profile.extract(samples.profiles(spark)).filter("source_profile_id = 'PT:301'").first().asDict()
    assert row["first_name"] == "Cleo" and row["last_name"] == "Ann Sample" and row["phone_number"] == "(555) 010-0123"
    assert row["all_specialties"] == "Trauma | Anxiety | Grief" and row["best_specialty"] == "Anxiety"
    assert row["client_focus"] == "Adults | Teen | Individuals" and row["client_focus_primary"] == "Adults" and row["client_focus_secondary"] == "Teen"
    assert row["insurance_details"] == "Plan A | Plan B" and row["payment_category"] == "hybrid"
    assert row["fee_raw"] == "Individual Sessions $150 - $ 180" and row["fee_clean"] == "$150-$180"
    assert row["availability_status"] == "not_accepting_new_clients"


def test_specialize_fallback(spark):
    page = "<h2>My Practice at a Glance</h2><p>I specialize in grief, loss and trauma. I accept all.</p>"
    row = profile.extract(spark.createDataFrame([("PT:1", "https://d.test/1", page)], "source_profile_id string, profile_url string, html string")).first()
    assert row["all_specialties"] == "grief | loss | trauma"


def test_next_page_by_rank_then_url(spark):
    page = '<a href="/b">next</a><a href="/z" rel="nofollow next">x</a><a href="/y" rel="next">x</a><a rel="NEXT" href="/a">x</a>'
    df = spark.createDataFrame([("https://d.test/", "https://d.test/", page)], "page_url string, directory_url string, html string")
    assert links.next_pages(df).first()["next_url"] == "https://d.test/y"


def test_discovery_bounds(spark):
    got = sorted(map(tuple, links.discovery(samples.listings(spark), 5, 4).select("page_no", "unique_profile").collect()))
    assert got == [(1, 3), (2, 5)]


def test_crawl_order_and_failure(spark):
    rows = crawl.crawl(samples.captured(spark), max_pages=4).collect()
    by_site = {s: [r["page_url"] for r in sorted((r for r in rows if r["site_id"] == s and r["seq"] is not None), key=lambda r: r["seq"])] for s in ("oak.test", "fir.test")}
    assert by_site["oak.test"] == ["https://oak.test/", "https://oak.test/contact", "https://oak.test/about-us", "https://oak.test/team"]
    assert by_site["fir.test"] == []
    assert [r["error"] is not None for r in rows if r["site_id"] == "fir.test"] == [True]


def score(spark, seen, first=None, last=None, site="https://www.oak-clinic.test/"):
    observed = spark.createDataFrame([("s", *r) for r in seen], "site_id string, page_url string, email string, source string")
    sites = spark.createDataFrame([("s", site, first, last)], "site_id string, website_url string, first_name string, last_name string")
    return {r["email"]: r["score"] for r in emails.score(observed, sites).collect()}


def test_scores(spark):
    page = "https://oak-clinic.test/contact"
    assert score(spark, [(page, "jo@mail.test", "text")], "Jo", "Doe") == {"jo@mail.test": 15 + 12 + 6 + 15 - 12 + 5}
    assert score(spark, [(page, "jo.billing@oak-clinic.test", "text")], "Jo", "Doe") == {"jo.billing@oak-clinic.test": 90}
    two = score(spark, [(page, "info@gmail.com", "mailto"), ("https://oak-clinic.test/", "info@gmail.com", "text"), (page, "press@x.test", "text")])
    assert two == {"info@gmail.com": 15 + 25 + 6 + 10 + 4 + 6, "press@x.test": 0}


def test_address_rules(spark):
    bad = ["noreply@a.test", "x@example.com", "a..b@c.test", "logo@2x.png", "x" * 65 + "@a.test"]
    page = "<p>" + " ".join([*bad, "Fine.One@A.test,", "ok@b.test"]) + "</p>"
    df = spark.createDataFrame([("s", 0, "https://a.test/", page)], "site_id string, seq int, page_url string, html string")
    assert sorted(r["email"] for r in emails.observe_pages(df).collect()) == ["fine.one@a.test", "ok@b.test"]
    texts = spark.createDataFrame([("s", "p", " ".join([*bad, "Fine.One@A.test,", "ok@b.test"])), ("s", "q", None), ("s", "r", "")], "site_id string, page_url string, text string")
    assert sorted(r["email"] for r in emails.observe_text(texts).collect()) == ["fine.one@a.test", "ok@b.test"]


def test_mailto_lists(spark):
    page = "<a href='mailto:A@x.test;b%40x.test?subject=c@x.test'>Mail us</a><noscript>d@x.test</noscript>"
    df = spark.createDataFrame([("s", 0, "https://a.test/", page)], "site_id string, seq int, page_url string, html string")
    assert [(r["email"], r["source"], r["snippet"]) for r in emails.observe_pages(df).orderBy("ord").collect()] == [("a@x.test", "mailto", "Mail us"), ("b@x.test", "mailto", "Mail us")]


def classified(spark, pages, url="https://a.test"):
    df = spark.createDataFrame([("s", i, u, h) for i, (u, h) in enumerate(pages)], "site_id string, seq int, page_url string, html string")
    return practice.classify(df, spark.createDataFrame([("s", url)], "site_id string, website_url string")).first()


def test_tie_goes_to_group(spark):
    row = classified(spark, [(f"https://a.test/{i}", "about me" if i == 0 else "our team meet our team find a therapist clinical team" if i == 1 else "") for i in range(12)])
    assert row["category"] == "group_practice"


def test_negative_margin_rounds_down(spark):
    said = "about me. contact me. work with me. my practice. my approach."
    row = classified(spark, [(f"https://a.test/{i}", said if i == 0 else "") for i in range(12)])
    assert (row["category"], row["category_score"]) == ("private_practice", 60)


def test_url_hint_is_substring_and_pages_are_unique(spark):
    row = classified(spark, [("https://a.test/our-team", ""), ("https://A.test/our-team/", ""), ("https://a.test/steam", "")], "https://www.a.org/x")
    assert row["category"] == "private_practice"  # 18 + 3 + 20 against 45
    assert row["category_evidence"] == ["Only 2 same-site pages were collected (private +45)."]


def test_pages_come_in_bounded_batches(spark):
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(limit, str(64 << 20))
    long = "<p>" + "x" * html.SLICE_CHARS
    pages = spark.createDataFrame([(1, "<a href='/a'>A</a>" + long + "<a href='/b'>B</a>"), (2, None), (3, "<a href=/c>C</a>" * 3), (4, long)], "k int, html string").coalesce(1)
    got = sorted(map(tuple, links.anchors(pages).select("k", "href", "label").collect()))
    assert got == [(1, "/a", "A"), (1, "/b", "B"), *[(3, "/c", "C")] * 3]
    assert int(spark.conf.get(limit)) == batches.BATCH_BYTES
    column = pd.Series(["x" * (html.SLICE_CHARS // 4), None] * 10)
    cut = list(html.slices(iter([column, pd.Series([], dtype="object")])))
    assert pd.concat(cut).tolist() == column.tolist() and max(s.str.len().sum() for s in cut) <= html.SLICE_CHARS and len(cut) == 3
