"""Links of listing pages and of a site's own pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.functions import urls
from plinth.functions.html import parse_anchors

_NO_PAGE = ("#", "mailto:", "tel:", "javascript:")


def anchors(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages without html, a row for each anchor: pos, href, rel, aria, text."""
    parsed = pages.withColumn("_p", parse_anchors(F.col(html))).drop(html)
    return parsed.select("*", F.explode("_p").alias("_a")).select(*(c for c in parsed.columns if c != "_p"), "_a.pos", "_a.href", "_a.rel", "_a.aria", F.col("_a.text").alias("label"))


def listing_links(pages: DataFrame) -> DataFrame:
    """Profile links of listings (page_url, directory_url, html): page_url, pos, profile_url; the first place of each."""
    h = urls.strip(F.col("href"))
    usable = h != ""
    for p in _NO_PAGE:
        usable = usable & ~h.startswith(p)
    found = anchors(pages).filter(usable).withColumn("profile_url", urls.normalize_url(urls.join_url(F.col("page_url"), h)))
    own = found.filter(urls.is_profile_url(F.col("profile_url"), F.col("directory_url")))
    return own.groupBy("page_url", "profile_url").agg(F.min("pos").alias("pos"))


def next_pages(pages: DataFrame) -> DataFrame:
    """page_url and next_url: a rel of next first, else a label that says so; of several the least URL."""
    h = urls.strip(F.col("href"))
    usable = h != ""
    for p in _NO_PAGE:
        usable = usable & ~h.startswith(p)
    label = F.lower(F.concat_ws(" ", F.col("label"), F.col("aria")))
    by_rel = F.array_contains(F.split("rel", r"(?U)\s+"), "next")
    said = label.contains("next page") | (F.trim(label) == "next")
    found = anchors(pages).filter(usable & (by_rel | said))
    target = urls.normalize_url(urls.join_url(F.col("page_url"), h))
    best = F.min(F.struct(F.when(by_rel, 0).otherwise(1).alias("rank"), target.alias("url")))
    return found.groupBy("page_url").agg(best.alias("_b")).select("page_url", F.col("_b.url").alias("next_url"))


def site_links(pages: DataFrame, root: str = "root_url") -> DataFrame:
    """Same-site links of pages (page_url, root_url, html): page_url, pos, link; the first place of each."""
    found = anchors(pages).withColumn("link", urls.normalize_page_url(F.col("href"), F.col("page_url")))
    own = found.filter((F.col("link") != "") & urls.is_same_site(F.col(root), F.col("link")))
    return own.groupBy("page_url", "link").agg(F.min("pos").alias("pos"))


def discovery(listings: DataFrame, max_profiles: int, max_pages: int) -> DataFrame:
    """Progress of a discovery run over captured listings (run_id, page_no, page_url, directory_url, html).

    One row for each page taken: run_id, page_no, found (all its profiles are stored),
    unique_profile (distinct so far, no more than max_profiles), next_page_url. Pages after
    the one that fills max_profiles are not taken.
    """
    from pyspark.sql import Window

    taken = listings.filter(F.col("page_no") <= max_pages)
    links = listing_links(taken).join(taken.select("run_id", "page_no", "page_url"), "page_url")
    first = links.groupBy("run_id", "profile_url").agg(F.min("page_no").alias("page_no"))
    new = first.groupBy("run_id", "page_no").agg(F.count(F.lit(1)).alias("new"))
    found = links.groupBy("run_id", "page_no").agg(F.count(F.lit(1)).alias("found"))
    rows = taken.select("run_id", "page_no", "page_url").join(found, ["run_id", "page_no"], "left").join(new, ["run_id", "page_no"], "left").join(next_pages(taken), "page_url", "left")
    run = Window.partitionBy("run_id").orderBy("page_no")
    before = F.coalesce(F.sum(F.coalesce("new", F.lit(0))).over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = rows.withColumn("_before", before).filter(F.col("_before") < max_profiles)
    return counted.select(
        "run_id", "page_no", F.coalesce("found", F.lit(0)).alias("found"),
        F.least(F.lit(max_profiles), F.col("_before") + F.coalesce("new", F.lit(0))).alias("unique_profile"), F.col("next_url").alias("next_page_url"),
    )
