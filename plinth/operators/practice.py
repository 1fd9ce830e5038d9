"""Classification of sites as private or group practices by counted signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions import text, urls
from plinth.functions.html import parse_html

# Hints in page paths and in texts, in the order in which evidence names them.
GROUP_URL = (
    "our-team", "meet-the-team", "meet-our-team", "team-4", "team", "staff", "providers", "provider", "clinicians",
    "clinician", "therapists", "therapist", "counselors", "counselor", "our-therapists", "our-clinicians",
    "our-providers", "provider-directory", "therapist-directory", "clinician-directory", "directory", "careers",
    "jobs", "leadership",
)
PRIVATE_URL = ("about-me", "contact-me", "work-with-me", "my-approach", "my-practice", "meet-me")
GROUP_TEXT = (
    "meet our team", "meet the team", "our team", "our therapists", "our clinicians", "our providers", "our counselors",
    "our staff", "clinical team", "provider team", "find a therapist", "find your therapist", "choose your therapist",
    "view all providers", "multiple locations", "our locations", "counseling center", "wellness center",
    "therapy center", "mental health center", "careers", "join our team", "we are hiring",
)
PRIVATE_TEXT = (
    "about me", "contact me", "work with me", "therapy with me", "my practice", "my approach", "i am a therapist",
    "i'm a therapist", "i provide therapy", "i specialize", "hi, i'm", "hello, i'm", "as your therapist",
)
STRONG_URL = (
    "our-team", "meet-the-team", "meet-our-team", "our-therapists", "our-clinicians", "our-providers",
    "provider-directory", "therapist-directory", "clinician-directory", "directory", "careers", "jobs", "leadership",
)
WEAK_URL = ("team", "provider", "clinician", "therapist", "counselor")

#: (kind, side, hint, points), in order of evidence.
HINTS: tuple[tuple[str, str, str, int], ...] = (
    *(("url", "group", h, 18 if h in STRONG_URL else 3 if h in WEAK_URL else 9) for h in GROUP_URL),
    *(("url", "private", h, 16) for h in PRIVATE_URL),
    *(("text", "group", h, 7) for h in GROUP_TEXT),
    *(("text", "private", h, 5) for h in PRIVATE_TEXT),
)
FEW, SOME, MANY = 3, 12, 20
MOST_EVIDENCE = 12


def hits(page_path: Column, page_text: Column) -> Column:
    """The places in HINTS of the hints that a page holds. One pass, no join: the list is fixed and short."""
    found = [F.when((page_path if kind == "url" else page_text).contains(h), F.lit(i)) for i, (kind, _, h, _) in enumerate(HINTS)]
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def confidence(winning: Column, opposing: Column) -> Column:
    """Halves and thirds are rounded down, below zero too."""
    half, third = F.floor(winning / 2), F.floor((winning - opposing) / 3)
    return F.greatest(F.lit(50), F.least(F.lit(100), 50 + F.least(F.lit(35), half) + F.least(F.lit(15), third))).cast("int")


def page_key(page_url: Column) -> Column:
    """A URL up to case and closing slashes."""
    key = F.lower(F.regexp_replace(page_url, "/+$", ""))
    return F.when(key == "", "/").otherwise(key)


def counted(found: DataFrame) -> DataFrame:
    """site_id, n_pages, hints of pages (site_id, seq, page_url, h: the places of their hints).

    Of pages that share a key the first crawled counts. Only the short arrays of hints are
    shuffled, and both aggregations combine before that.
    """
    first = F.min_by("h", F.struct("seq", "page_url")).alias("h")
    once = found.groupBy("site_id", page_key(F.col("page_url")).alias("_key")).agg(first)
    return once.groupBy("site_id").agg(F.count(F.lit(1)).alias("n_pages"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("h")))).alias("hints"))


def decide(counts: DataFrame) -> DataFrame:
    """category, category_score, group_score, private_score of counts (site_id, n_pages, org, hints).

    hints: array of places in HINTS, each once.
    """
    sides, worth = _tables()
    points = lambda side: F.aggregate(
        F.filter("hints", lambda i: F.get(sides, i) == side), F.lit(0), lambda s, i: s + F.get(worth, i)
    )
    group = F.when(F.col("n_pages") >= SOME, 30).otherwise(0) + F.when(F.col("org"), 20).otherwise(0) + points("group")
    private = F.when(F.col("n_pages") <= FEW, 45).when(F.col("n_pages") < SOME, 25).otherwise(0) + points("private")
    scored = counts.withColumns({"group_score": group.cast("int"), "private_score": private.cast("int")})
    structural = F.col("org") | F.exists("hints", lambda i: F.get(sides, i) == "group") | (F.col("n_pages") >= MANY)
    is_group = (F.col("group_score") >= F.col("private_score")) & structural
    win, lose = F.when(is_group, F.col("group_score")).otherwise(F.col("private_score")), F.when(is_group, F.col("private_score")).otherwise(F.col("group_score"))
    return scored.withColumns({"category": F.when(is_group, "group_practice").otherwise("private_practice"), "category_score": confidence(win, lose)})


def _tables() -> tuple[Column, Column]:
    return F.array(*(F.lit(side) for _, side, _, _ in HINTS)), F.array(*(F.lit(p) for *_, p in HINTS))


def _said(i: Column) -> Column:
    # The sentences of evidence, here and in classify.
    table = F.array(
        *(
            F.lit(
                (f"URL hint '{h}' indicates a group structure (group +{p})." if side == "group" else f"URL hint '{h}' indicates an individual practice (private +{p}).")
                if kind == "url"
                else f"Website text contains '{h}' ({side} +{p})."
            )
            for kind, side, h, p in HINTS
        )
    )
    return F.get(table, i)


def found_on(parsed: DataFrame) -> DataFrame:
    """site_id, seq, page_url, h of pages (site_id, seq, page_url, p: what parse_html gives)."""
    said = hits(F.lower(urls.path_only(F.col("page_url"))), F.col("_shown"))
    return parsed.withColumn("_shown", text.fold(F.col("p.visible_text"))).select("site_id", "seq", "page_url", said.alias("h"))


def classify(pages: DataFrame, sites: DataFrame) -> DataFrame:
    """classify_found of pages (site_id, seq, page_url, html), each parsed once."""
    return classify_found(found_on(pages.select("site_id", "seq", "page_url", parse_html("html").alias("p"))), sites)


def classify_found(found: DataFrame, sites: DataFrame) -> DataFrame:
    """site_id, category, category_score, category_evidence of what was found on pages (site_id, seq, page_url, h).

    sites: site_id, website_url. A hint counts once a site, wherever it stands.
    """
    org = urls.site_host(F.col("website_url")).endswith(".org")
    decided = decide(counted(found).join(sites.select("site_id", org.alias("org")), "site_id"))
    sides, _ = _tables()
    won = F.regexp_extract("category", "^[a-z]+", 0)
    n = F.col("n_pages").cast("string")
    pages_said = (
        F.when((won == "private") & (F.col("n_pages") <= FEW), F.concat(F.lit("Only "), n, F.lit(" same-site pages were collected (private +45).")))
        .when((won == "private") & (F.col("n_pages") < SOME), F.concat(F.lit("Only "), n, F.lit(" same-site pages were collected (private +25).")))
        .when((won == "group") & (F.col("n_pages") >= SOME), F.concat(n, F.lit(" same-site pages were collected (group +30).")))
    )
    org_said = F.when((won == "group") & F.col("org"), "The website uses a .org domain (group +20).")
    hints_said = F.transform(F.filter("hints", lambda i: F.get(sides, i) == won), _said)
    all_said = F.filter(F.concat(F.array(pages_said, org_said), hints_said), lambda x: x.isNotNull())
    alone = "A larger page count without team, provider, clinician, or .org signals is insufficient by itself to label a group practice."
    said = F.when((F.size(all_said) == 0) & (F.col("n_pages") >= SOME), F.array(F.lit(alone))).otherwise(F.slice(all_said, 1, MOST_EVIDENCE))
    return decided.select("site_id", "category", "category_score", said.alias("category_evidence"))
