"""URL algebra as column expressions.

URLs are taken apart by regular expressions, since Spark's own parser rejects or alters
what a lenient parser accepts. Only joining a relative reference with dots or a path of
its own to a base needs Python; rooted, absolute and query-only references stay native.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Keywords of page paths and the crawl priority that each group gives.
PRIORITIES: tuple[tuple[int, tuple[str, ...]], ...] = (
    (10, ("contact", "appointment", "schedule", "book", "consult", "intake", "get-started", "start-here")),
    (20, ("about", "meet", "bio", "our-story")),
    (30, ("service", "services", "therapy", "therapies", "counseling", "counselling", "treatment", "specialties", "specialty", "areas")),
    (40, ("team", "staff", "therapists", "clinicians", "providers")),
    (50, ("faq", "faqs", "questions")),
    (200, ("privacy", "terms", "cookie", "cookies", "disclaimer", "accessibility", "sitemap")),
    (80, ("blog", "article", "articles", "post", "news", "resources")),
)
ROOT_PRIORITY, OTHER_PRIORITY = 0, 60

# Link prefixes that lead to no page.
SKIPPED_PREFIXES = ("mailto:", "tel:", "sms:", "javascript:", "#")

# Domains whose pages list others' profiles; subdomains belong to them.
DIRECTORY_DOMAINS = (
    "headway.co", "growtherapy.com", "lifestance.com", "helloalma.com", "sondermind.com", "rula.com",
    "goodtherapy.org", "therapyden.com", "zocdoc.com", "openpathcollective.org", "mentalhealthmatch.com",
    "therapytribe.com", "therapist.com", "inclusivetherapists.com", "healthgrades.com", "workable.com",
    "cookieyes.com", "instagram.com",
)

# Codes and names of the states.
STATES = {
    "al": "Alabama", "ak": "Alaska", "az": "Arizona", "ar": "Arkansas", "ca": "California", "co": "Colorado",
    "ct": "Connecticut", "de": "Delaware", "fl": "Florida", "ga": "Georgia", "hi": "Hawaii", "id": "Idaho",
    "il": "Illinois", "in": "Indiana", "ia": "Iowa", "ks": "Kansas", "ky": "Kentucky", "la": "Louisiana",
    "me": "Maine", "md": "Maryland", "ma": "Massachusetts", "mi": "Michigan", "mn": "Minnesota",
    "ms": "Mississippi", "mo": "Missouri", "mt": "Montana", "ne": "Nebraska", "nv": "Nevada",
    "nh": "New Hampshire", "nj": "New Jersey", "nm": "New Mexico", "ny": "New York", "nc": "North Carolina",
    "nd": "North Dakota", "oh": "Ohio", "ok": "Oklahoma", "or": "Oregon", "pa": "Pennsylvania",
    "ri": "Rhode Island", "sc": "South Carolina", "sd": "South Dakota", "tn": "Tennessee", "tx": "Texas",
    "ut": "Utah", "vt": "Vermont", "va": "Virginia", "wa": "Washington", "wv": "West Virginia",
    "wi": "Wisconsin", "wy": "Wyoming", "dc": "District of Columbia",
}

#: Host of the directory from which listings and profiles come, and its name in records.
SOURCE_HOST, SOURCE_NAME = "psychologytoday.com", "psychology_today"
#: Marks a profile that has no outward link.
UNAVAILABLE = "__unavailable__"

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
_QUERY = r"^[^?#]*\?([^#]*)"


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value worked out once however often then uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def strip(text: Column) -> Column:
    """text without white space at either end, beyond ASCII too."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _SCHEME, 1))


def netloc(url: Column) -> Column:
    return F.regexp_extract(url, _AUTHORITY, 1)


def hostname(url: Column) -> Column:
    """The host in lower case, without user or port; empty if there is none."""
    host = F.regexp_replace(netloc(url), "^.*@", "")
    bare = F.when(host.startswith("["), F.regexp_extract(host, r"^\[([^\]]*)", 1)).otherwise(F.regexp_extract(host, "^([^:]*)", 1))
    return F.lower(bare)


def port(url: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(netloc(url), "^.*@", ""), r":([0-9]+)$", 1)


def path(url: Column) -> Column:
    """The path with its parameters."""
    return F.regexp_extract(url, _PATH, 1)


def path_only(url: Column) -> Column:
    """The path without the last segment's parameters."""
    return F.regexp_replace(path(url), r";[^/]*$", "")


def query(url: Column) -> Column:
    return F.regexp_extract(url, _QUERY, 1)


def site_host(url: Column) -> Column:
    """The host without a leading www."""
    return F.regexp_replace(hostname(url), r"^www\.", "")


def normalize_url(url: Column) -> Column:
    """Scheme and authority in lower case, an empty path as /, no fragment, no tab or line end; else the stripped input."""

    def parts(raw: Column) -> Column:
        u = F.translate(raw, "\t\r\n", "")
        asked = F.when(query(u) != "", F.concat(F.lit("?"), query(u))).otherwise("")
        whole = F.concat(scheme(u), F.lit("://"), F.lower(netloc(u)), F.when(path(u) == "", "/").otherwise(path(u)), asked)
        return F.when((scheme(u) == "") | (netloc(u) == ""), raw).otherwise(whole)

    return let(strip(url), parts)


def same_netloc(a: Column, b: Column) -> Column:
    """Whether authorities agree, port and www included."""
    return (netloc(a) != "") & (F.lower(netloc(a)) == F.lower(netloc(b)))


def is_same_site(a: Column, b: Column) -> Column:
    """Whether hosts agree, whatever the port and a leading www."""
    return (site_host(a) != "") & (site_host(a) == site_host(b))


def directory_name(url: Column) -> Column:
    host = hostname(url)
    return (
        F.when(host.contains(SOURCE_HOST), SOURCE_NAME)
        .when(host.contains("goodtherapy.org") | host.contains("goodtherapy.com"), "good_therapy")
        .otherwise(F.replace(F.regexp_replace(host, r"^www\.", ""), F.lit("."), F.lit("_")))
    )


def clean_website_url(raw: Column) -> Column:
    u = strip(F.coalesce(raw, F.lit("")))
    return F.when(u == "", "").when(u.startswith("//"), F.concat(F.lit("https:"), u)).when(F.lower(u).rlike("^https?://"), u).otherwise(F.concat(F.lit("https://"), u))


@F.pandas_udf(T.StringType())
def _joined(base: pd.Series, href: pd.Series) -> pd.Series:
    def one(b: str | None, h: str | None) -> str | None:
        try:
            return urljoin(b or "", h) if h is not None else None
        except ValueError:
            return ""

    return pd.Series([one(b, h) for b, h in zip(base, href)], dtype="object")


def join_url(base: Column, href: Column, exact: bool = True) -> Column:
    """href as seen from base. exact=False leaves out references that only Python joins, as null."""
    root = F.concat(scheme(base), F.lit("://"), netloc(base))
    plain = ~href.rlike(r"(?:^|/)\.{1,2}(?:[/?#;]|$)")
    out = (
        F.when(href == "", base)
        .when(href.rlike("^(?i)https?://[^/?#]+/") & plain, href)
        .when(href.rlike("^/[^/]") & plain & base.rlike("^(?i)https?://[^/?#]+"), F.concat(root, href))
    )
    return out.otherwise(_joined(base, href)) if exact else out


def normalize_joined(url: Column) -> Column:
    """An absolute URL for crawling: http(s) only, no user, parameters, fragment or closing slash; else empty."""

    def parts(u: Column) -> Column:
        shown = let(path_only(u), lambda p: F.when((p == "") | (p == "/"), "/").otherwise(F.regexp_replace(p, "/+$", "")))
        asked = F.when(query(u) != "", F.concat(F.lit("?"), query(u))).otherwise("")
        number = let(port(u), lambda n: F.when(n != "", F.concat(F.lit(":"), n.try_cast("int").cast("string"))).otherwise(""))
        whole = F.concat(scheme(u), F.lit("://"), hostname(u), number, shown, asked)
        return F.when(scheme(u).isin("http", "https") & (hostname(u) != ""), whole).otherwise("")

    return let(url, parts)


def normalize_page_url(href: Column, base: Column, exact: bool = True) -> Column:
    h = strip(F.coalesce(href, F.lit("")))
    low = F.lower(h)
    skipped = h == ""
    for prefix in SKIPPED_PREFIXES:
        skipped = skipped | low.startswith(prefix)
    return F.when(skipped, "").otherwise(normalize_joined(join_url(base, h, exact)))


def url_priority(url: Column) -> Column:
    """The crawl priority of a page by its path; less comes first."""

    def by_path(p: Column) -> Column:
        out = F.when(p == "", ROOT_PRIORITY)
        for value, words in PRIORITIES:  # no keyword holds a slash, so a segment holds it if the path does
            hit = F.lit(False)
            for w in words:
                hit = hit | p.contains(w)
            out = out.when(hit, value)
        return out.otherwise(OTHER_PRIORITY)

    return let(F.regexp_replace(F.lower(path_only(url)), "^/+|/+$", ""), by_path)


def link_target(href: str, base: str) -> str:
    """normalize_page_url of one link, for code that must go link by link."""
    h = href.strip()
    if not h or h.casefold().startswith(SKIPPED_PREFIXES):
        return ""
    try:
        to = urlsplit(urljoin(base, h))
        host, number = to.hostname, to.port
    except ValueError:
        return ""
    if to.scheme not in ("http", "https") or not host:
        return ""
    path_ = re.sub(r";[^/]*$", "", to.path).rstrip("/") or "/"
    return "".join((to.scheme, "://", host, "" if number is None else f":{number}", path_, to.query and f"?{to.query}"))


def link_site(url: str) -> str:
    """site_host of one URL."""
    return (urlsplit(url).hostname or "").removeprefix("www.")


def link_priority(url: str) -> int:
    """url_priority of one URL."""
    path_ = re.sub(r";[^/]*$", "", urlsplit(url).path).lower().strip("/")
    by_word = (value for value, words in PRIORITIES if any(w in path_ for w in words))
    return next(by_word, OTHER_PRIORITY) if path_ else ROOT_PRIORITY


def _segments(url: Column) -> Column:
    return F.filter(F.split(path_only(url), "/"), lambda s: s != "")


def _titled(text: Column) -> Column:
    """Every run of letters with a capital first, as after an apostrophe."""
    parts = F.regexp_extract_all(text, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 1 << 30)))), "")


def directory_location(url: Column) -> Column:
    """struct(state, city) of a listing's URL; both empty if it isn't one."""
    s = _segments(url)
    names = F.create_map(*(F.lit(x) for kv in STATES.items() for x in kv))
    fits = (F.size(s) >= 4) & (F.get(s, F.lit(0)) == "us") & (F.get(s, F.lit(1)) == "therapists")
    code = F.lower(F.get(s, F.lit(2)))
    city = F.try_url_decode(F.replace(F.get(s, F.lit(3)), F.lit("+"), F.lit("%2B")))
    city = _titled(F.replace(F.coalesce(city, F.get(s, F.lit(3))), F.lit("-"), F.lit(" ")))
    return F.struct(
        F.when(fits, F.coalesce(F.try_element_at(names, code), F.upper(code))).otherwise("").alias("state"),
        F.when(fits, city).otherwise("").alias("city"),
    )


def profile_id(url: Column) -> Column:
    """The last segment of the path if it is a number, else empty."""
    return F.regexp_extract(F.regexp_replace(path_only(url), "/+$", ""), r"(?:^|/)([0-9]+)$", 1)


def source_profile_id(url: Column) -> Column:
    return F.concat(F.lit("PT:"), profile_id(url))


def is_profile_url(url: Column, directory_url: Column) -> Column:
    own, listing = F.regexp_replace(path_only(url), "/+$", ""), F.regexp_replace(path_only(directory_url), "/+$", "")
    s = _segments(url)
    below = F.size(s) - 2
    named = (below == 2) & ~F.lower(F.coalesce(F.get(s, F.lit(2)), F.lit(""))).isin(*STATES)
    return same_netloc(url, directory_url) & own.startswith("/us/therapists/") & (own != listing) & ((below >= 3) | named)


def under(host: Column, domains: tuple[str, ...]) -> Column:
    """Whether host is one of domains or below one: its endings are looked up, not compared one by one."""
    labels = F.split(host, r"\.")
    endings = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels), F.lit(1))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.arrays_overlap(endings, F.array(*(F.lit(d) for d in domains)))


def destination_type(url: Column) -> Column:
    return F.when(under(hostname(url), DIRECTORY_DOMAINS), "directory").otherwise("owned_website")


def redirect_endpoint(url: Column) -> Column:
    """The address behind a profile's outward link; null if the link hasn't the known form."""
    s = F.split(F.regexp_replace(path_only(url), "^/+|/+$", ""), "/")
    number = F.get(s, F.lit(2))
    fits = (
        scheme(url).isin("http", "https")
        & hostname(url).endswith(SOURCE_HOST)
        & (F.size(s) == 4)
        & (F.get(s, F.lit(0)) == "us")
        & (F.get(s, F.lit(1)) == "profile")
        & number.rlike("^[0-9]+$")
        & (F.get(s, F.lit(3)) == "website")
    )
    return F.when(fits, F.concat(F.lit(f"https://out.{SOURCE_HOST}/us/profile/"), number, F.lit("/website-redirect")))


def is_external_website(url: Column) -> Column:
    return scheme(url).isin("http", "https") & (hostname(url) != "") & ~under(hostname(url), (SOURCE_HOST,))


def is_available_redirect(url: Column) -> Column:
    return F.coalesce((url != UNAVAILABLE) & scheme(url).isin("http", "https") & (netloc(url) != ""), F.lit(False))


#: HTTP statuses that carry a target.
REDIRECTS = (301, 302, 303, 307, 308)


def redirect_outcome(endpoint: Column, status: Column, location: Column) -> Column:
    """struct(website_url, error) of a captured response."""
    bad = F.concat(F.lit("outbound endpoint returned unexpected status "), status.cast("string"))
    ok = status.isin(*REDIRECTS) & (F.coalesce(location, F.lit("")) != "")
    return F.struct(
        F.when(ok, join_url(endpoint, location)).alias("website_url"),
        F.when(~F.coalesce(status.isin(*REDIRECTS), F.lit(False)), F.coalesce(bad, F.lit("no response")))
        .when(F.coalesce(location, F.lit("")) == "", "outbound endpoint returned no Location header")
        .alias("error"),
    )


def canonical(url: Column) -> Column:
    """For comparing two URLs: lower case, no closing slash."""
    return F.regexp_replace(F.lower(strip(url)), "/+$", "")
