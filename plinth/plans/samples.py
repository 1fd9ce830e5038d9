"""Invented pages for operators that no driver table exercises. All names and hosts are made up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_LISTING = """<html><body>
<a href="/us/therapists/ana-sample/{a}">Ana</a> <a href="/us/therapists/ca/los-angeles/ben-sample/{b}">Ben</a>
<a href="/us/therapists/ca/los-angeles">Here</a> <a href="#top">Top</a> <a href="mailto:x@clinic.test">Mail</a>
<a href="/us/therapists/ana-sample/{a}?ref=1#x">Ana again</a> <a rel="next" href="?page={n}">More</a> <a href="/zz">next</a>
</body></html>"""

_PROFILE = """<html><head><meta property="og:title" content="Cleo Sample, Counselor"></head><body><h1>Cleo  Ann Sample</h1>
<p>I work with adults and teens. Anxiety is common; anxiety can be treated.</p><a href="tel:+15550100123">(555) 010-0123</a>
<h2>My Practice at a Glance</h2><div><div>I am not accepting new clients at this time.</div></div><p>I accept insurance and offer a superbill.</p>
<h2>Finances</h2><h3>Fees</h3><ul><li>Individual Sessions $150 - $ 180</li></ul><h3>Insurance</h3><ul><li>Plan A</li><li>plan a</li><li>Plan B</li></ul>
<h2>Specialties and Expertise</h2><h3>Top Specialties</h3><ul><li>Trauma</li><li>Anxiety</li></ul><h3>Expertise</h3><ul><li>Grief</li><li>anxiety</li></ul>
<h2>Client Focus</h2><h3>Age</h3><span data-x="attribute-age"><span>Adults, Teen</span></span><h3>Participants</h3><ul><li>Individuals</li></ul>
<h2>Location</h2><p>Nowhere</p><a data-x="website-link" href="/us/profile/{n}/website">Website</a></body></html>"""


def listings(spark: SparkSession) -> DataFrame:
    root = "https://www.psychologytoday.com/us/therapists/ca/los-angeles"
    rows = [(1, k, f"{root}?page={k}" if k > 1 else root, root, _LISTING.format(a=100 + k // 2, b=200 + k, n=k + 1)) for k in range(1, 6)]
    return spark.createDataFrame(rows, "run_id int, page_no int, page_url string, directory_url string, html string")


def profiles(spark: SparkSession) -> DataFrame:
    rows = [(f"PT:{n}", f"https://www.psychologytoday.com/us/therapists/cleo-sample/{n}", _PROFILE.format(n=n)) for n in (301, 302)]
    rows.append(("PT:303", "https://www.psychologytoday.com/us/therapists/empty/303", ""))
    return spark.createDataFrame(rows, "source_profile_id string, profile_url string, html string")


def captured(spark: SparkSession) -> DataFrame:
    home = '<a href="/blog/a">b</a><a href="/contact/">c</a><a href="about-us">a</a><a href="https://other.test/x">o</a><a href="/team">t</a>'
    rows = []
    for s in ("oak.test", "elm.test", "fir.test"):
        root = f"https://{s}"
        pages = {"": home, "/contact": "<a href='/privacy'>p</a> mailto <a href='mailto:Info@{0};jo.sample@{0}?subject=x'>Write</a>".format(s), "/about-us": "about me: jo.sample [at] oak (dot) test", "/blog/a": "post", "/team": "our team", "/privacy": "rules"}
        rows += [(s, s, root + p, root + (p or "/"), 200, f"<p>{h}</p>") for p, h in pages.items() if not (s == "fir.test" and p == "/about-us")]
    return spark.createDataFrame(rows, "site_id string, website_url string, requested_url string, final_url string, status int, html string")


def sites(spark: SparkSession) -> DataFrame:
    rows = [(s, f"https://{s}", "Jo", "Sample") for s in ("oak.test", "elm.test", "fir.test")]
    return spark.createDataFrame(rows, "site_id string, website_url string, first_name string, last_name string")


def hard_texts(spark: SparkSession) -> DataFrame:
    nbsp = "\u00a0"
    said = [
        "\u00e9contact@a.test", "x@a.test\u00e9", "(x@b.test)", f"jo{nbsp}at{nbsp}c{nbsp}dot{nbsp}test", "jo at d dot mail dot test.", "\u00e9jo at e dot test", "JO [AT] f (dot) TEST",
        "look at this", "a+b@g.test, c@g.test; c@g.test", "noreply@h.test y@example.com z@i.png", ".x@j.test", "x..y@k.test", "x@-l.test", "x@m.test-y", "two{at}n.test{dot}org", None, "",
    ]
    return spark.createDataFrame([("s", f"p{i:02d}", t) for i, t in enumerate(said)], "site_id string, page_url string, text string")


def names(spark: SparkSession) -> DataFrame:
    rows = [(1, "jo.weiss", "Jo", "Wei\u00df"), (2, "weiss", None, "WEI\u1e9e"), (3, "jo", "Jo", ""), (4, "dojo", "Jo", "Do"), (5, "do.x.jo", "Jo", "Do"), (6, "info", "Jo", "Do"), (7, "jose", "Jos\u00e9", None), (8, "jos", "Jos\u00e9", None)]
    return spark.createDataFrame(rows, "k int, part string, first string, last string")


def open_runs(spark: SparkSession, running: bool = False) -> DataFrame:
    rows = [(1, "a", "https://d.test/1", "completed", 1, "x"), (2, "a", "https://d.test/2", "pending", 3, "x"), (3, "a", "https://d.test/3", "failed", 2, "x"), (4, "a", "https://d.test/2", "failed", 4, "x"), (5, "a", "https://d.test/5", "pending", 0, None)]
    rows += [(6, "a", "https://d.test/6", "running", 9, "x"), (7, "a", "https://d.test/7", "running", 8, "x")] if running else []
    return spark.createDataFrame(rows, "id int, directory string, start_url string, status string, day int, next_page_url string").selectExpr("id", "directory", "start_url", "status", "next_page_url", "timestamp_seconds(86400 * day) AS created_at", "CAST(NULL AS timestamp) AS completed_at")
