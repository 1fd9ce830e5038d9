from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from plinth.functions import urls


def one(spark, column, *values):
    names = "abc"[: len(values)]
    return spark.createDataFrame([values], ", ".join(f"{n} string" for n in names)).select(column(*(F.col(n) for n in names)).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "url, want",
    [
        (" HTTP://Ex.Test/A;p?q=1#f ", "http://ex.test/A;p?q=1"),
        ("https://ex.test", "https://ex.test/"),
        ("/relative/x ", "/relative/x"),
        ("mailto:a@b", "mailto:a@b"),
        ("", ""),
    ],
)
def test_normalize_url(spark, url, want):
    assert one(spark, urls.normalize_url, url) == want


PAGES = [
    ("contact/", "https://Ex.test/a/b", "https://ex.test/a/contact"),
    ("../x;p?q=1#f", "https://ex.test/a/b/", "https://ex.test/a/x?q=1"),
    ("/", "https://user@ex.test:8080/a", "https://ex.test:8080/"),
    ("?page=2", "https://ex.test/a", "https://ex.test/a?page=2"),
    ("//Other.test/z/", "http://ex.test/", "http://other.test/z"),
    ("MAILTO:x@y.test", "https://ex.test/", ""),
    ("#top", "https://ex.test/", ""),
    ("ftp://ex.test/x", "https://ex.test/", ""),
    ("https://ex.test/a/../b", "https://ex.test/", "https://ex.test/a/../b"),
    ("  ", "https://ex.test/", ""),
]


@pytest.mark.parametrize("href, base, want", PAGES)
def test_normalize_page_url(spark, href, base, want):
    assert one(spark, urls.normalize_page_url, href, base) == want
    assert urls.link_target(href, base) == want


def test_native_joins_equal_the_library(spark):
    for href in ("/a", "https://q.test/b?c", "/a?b#c", "https://q.test/"):
        got = one(spark, lambda b, h: urls.join_url(b, h, exact=False), "https://ex.test/x/y", href)
        assert got == urljoin("https://ex.test/x/y", href)


@pytest.mark.parametrize(
    "path, want",
    [
        ("", 0), ("/contact-us", 10), ("/facebook", 10), ("/biofeedback", 20), ("/services/x", 30), ("/steam", 40), ("/faq", 50),
        ("/privacy-questions", 50), ("/terms", 200), ("/blog/terms", 200), ("/postpartum", 80), ("/zzz", 60),
    ],
)
def test_priority(spark, path, want):
    assert one(spark, urls.url_priority, f"https://contact.test{path}") == want
    assert urls.link_priority(f"https://contact.test{path}") == want


@pytest.mark.parametrize(
    "url, want",
    [
        ("https://care.headway.co/x", "directory"), ("https://headway.co", "directory"), ("https://notheadway.co", "owned_website"),
        ("https://WWW.Rula.com/", "directory"), ("https://rula.com.test/", "owned_website"), ("https://u@therapist.com:8/", "directory"),
    ],
)
def test_destination(spark, url, want):
    assert one(spark, urls.destination_type, url) == want


def test_same_site_and_netloc(spark):
    assert one(spark, urls.is_same_site, "https://www.a.test:1/x", "http://A.test/") is True
    assert one(spark, urls.is_same_site, "https://b.a.test/", "http://a.test/") is False
    assert one(spark, urls.same_netloc, "https://www.a.test/", "https://a.test/") is False


def test_listing_places(spark):
    got = one(spark, urls.directory_location, "https://x.test/us/therapists/nh/o%27fallon-town+n?page=2")
    assert tuple(got) == ("New Hampshire", "O'Fallon Town+N")
    assert tuple(one(spark, urls.directory_location, "https://x.test/us/therapists/zz/a")) == ("ZZ", "A")
    assert tuple(one(spark, urls.directory_location, "https://x.test/uk/therapists/zz/a")) == ("", "")


@pytest.mark.parametrize(
    "url, want",
    [
        ("https://d.test/us/therapists/ana/12", True), ("https://d.test/us/therapists/ca/la/ana", True), ("https://d.test/us/therapists/ca/la", False),
        ("https://d.test/us/therapists/CA/x", False), ("https://d.test/us/therapists/x", False), ("https://www.d.test/us/therapists/ana/12", False),
    ],
)
def test_profile_urls(spark, url, want):
    assert one(spark, urls.is_profile_url, url, "https://d.test/us/therapists/ca/la") is want


def test_profile_ids(spark):
    assert one(spark, urls.profile_id, "https://d.test/us/therapists/ana/12/") == "12"
    assert one(spark, urls.profile_id, "https://d.test/us/therapists/ana/12a") == ""


def test_redirects(spark):
    good = "https://www.psychologytoday.com/us/profile/77/website"
    assert one(spark, urls.redirect_endpoint, good).endswith("/us/profile/77/website-redirect")
    assert one(spark, urls.redirect_endpoint, good + "/x") is None
    assert one(spark, urls.is_available_redirect, urls.UNAVAILABLE) is False
    assert one(spark, urls.is_external_website, "https://out.psychologytoday.com/x") is False
    assert one(spark, urls.is_external_website, "https://notpsychologytoday.com/x") is True


def test_clean_website_url(spark):
    for raw, want in ((" a.test ", "https://a.test"), ("//a.test", "https://a.test"), ("HTTP://a", "HTTP://a"), ("", ""), (None, "")):
        assert one(spark, urls.clean_website_url, raw) == want
