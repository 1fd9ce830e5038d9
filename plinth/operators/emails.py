"""Mining and ranking of e-mail addresses."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.functions import text as text_rules
from plinth.functions import urls
from plinth.functions.html import parse_html
from plinth.sources.files import settled

# The patterns of addresses, as they are and spelled out, domains and local parts that the rules name.
LOCAL = r"[a-z0-9.!#$%&'*+/=?^_`{|}~-]+"
LABEL = r"[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?"
ADDRESS = rf"(?i)(?<![\w.+-]){LOCAL}@{LABEL}(?:\.{LABEL})+(?![\w.-])"
SPELLED = r"(?i)\b([a-z0-9._%+-]+)\s+at\s+([a-z0-9-]+(?:\s+dot\s+[a-z0-9-]+)+)\b"
BRACKETED = {"@": r"(?i)\s*(?:\[at\]|\(at\)|\{at\})\s*", ".": r"(?i)\s*(?:\[dot\]|\(dot\)|\{dot\})\s*"}
#: Put before a pattern, for word characters, their ends and white space beyond ASCII.
WIDE = "(?U)"
FREE_DOMAINS = ("gmail.com", "outlook.com", "hotmail.com", "live.com", "yahoo.com", "icloud.com", "proton.me", "protonmail.com", "aol.com")
ROLE_PARTS = ("contact", "hello", "info", "office", "intake", "appointments")
LOW_VALUE_PARTS = ("support", "blog", "webmaster", "marketing", "sales", "billing", "careers", "jobs", "press", "media", "privacy", "legal")
REJECTED_PARTS = ("noreply", "no-reply", "donotreply", "do-not-reply", "example", "test", "yourname", "name", "email")
REJECTED_DOMAINS = ("example.com", "example.org", "example.net", "wordpress.com", "wixpress.com", "squarespace.com")
ASSET_ENDINGS = ("css", "gif", "ico", "jpeg", "jpg", "js", "png", "svg", "ttf", "webp", "woff", "woff2")
PAGE_BONUS = {0: 2, 10: 6, 20: 4, 30: 2, 40: 4, 50: 1, 60: 0, 80: -3, 200: -6}
STRIPPED = " <>[](){}.,;:'\""

RETAINED, BEST, MOST = 20, 40, 90
SNIPPET, AROUND, EVIDENCE = 240, 80, 6

_ADDRESS = re.compile(ADDRESS)


def normalize(found: Column) -> Column:
    """The address in lower case, or null if the rules reject it."""
    e = F.lower(F.btrim(found, F.lit(STRIPPED)))
    local, domain = F.substring_index(e, "@", 1), F.substring_index(e, "@", -1)
    fine = (
        (F.length(e) <= 254)
        & (F.length(e) - F.length(F.replace(e, F.lit("@"))) == 1)
        & F.length(local).between(1, 64)
        & ~local.startswith(".")
        & ~local.endswith(".")
        & ~local.contains("..")
        & ~local.isin(*REJECTED_PARTS)
        & ~domain.isin(*REJECTED_DOMAINS)
        & ~F.substring_index(domain, ".", -1).isin(*ASSET_ENDINGS)
    )
    return F.when(fine, e)


def deobfuscate(text: Column) -> Column:
    """Addresses written out with at and dot, in words or in brackets; as many dots as there are."""
    spelled = F.regexp_replace(text, WIDE + SPELLED, "$1\x01@$2\x02")

    def dotted(t: Column) -> Column:
        dots = F.when(t.contains("\x01@"), F.regexp_count(t, F.lit(rf"{WIDE}(?i)\s+dot\s+"))).otherwise(0)
        turns = F.when(dots > 0, F.sequence(F.lit(1), dots)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(turns, t, lambda x, _: F.regexp_replace(x, f"{WIDE}(?i)(\x01@[^\x02]*?)\\s+dot\\s+", "$1."))

    out = F.translate(urls.let(spelled, dotted), "\x01\x02", "")
    for sign, pattern in BRACKETED.items():
        out = F.regexp_replace(out, WIDE + pattern, sign)
    return out


def observe_text(texts: DataFrame, text: str = "text") -> DataFrame:
    """site_id, page_url, email, source of plain texts: each address once a page. Native throughout."""
    found = F.regexp_extract_all(deobfuscate(F.col(text)), F.lit(f"{WIDE}({ADDRESS})"), F.lit(1))
    rows = texts.filter(F.col(text).contains("@") | F.col(text).rlike(r"(?i)at")).select("site_id", "page_url", F.explode(found).alias("m"))
    return rows.select("site_id", "page_url", normalize(F.col("m")).alias("email"), F.lit("text").alias("source")).filter("email is not null").distinct()


def _valid(value: str) -> list[tuple[str, int, int]]:
    out = []
    for m in _ADDRESS.finditer(value):
        e = m[0].strip(STRIPPED).casefold()
        local, _, domain = e.rpartition("@")
        fine = len(e) <= 254 and e.count("@") == 1 and 0 < len(local) <= 64 and local[0] != "." and local[-1] != "." and ".." not in local
        if fine and local not in REJECTED_PARTS and domain not in REJECTED_DOMAINS and domain.rsplit(".", 1)[-1] not in ASSET_ENDINGS:
            out.append((e, m.start(), m.end()))
    return out


def _observed(email_text: str | None, anchors) -> list[dict]:
    out: dict[tuple[str, str], dict] = {}

    def add(email: str, source: str, snippet: str) -> None:
        out.setdefault((email, source), {"ord": len(out), "email": email, "source": source, "snippet": " ".join(snippet.split())[:SNIPPET]})

    for a in anchors if anchors is not None else ():
        href = unescape(a["href"]).strip()
        if href.casefold().startswith("mailto:"):
            for e, _, _ in _valid(unquote(href[7:].split("?", 1)[0]).replace(";", ",")):
                add(e, "mailto", a["text"] or href)
    shown = email_text or ""
    for e, start, end in _valid(shown):
        add(e, "text", shown[max(0, start - AROUND) : end + AROUND])
    return list(out.values())


_SEEN = T.StructType([T.StructField("ord", T.IntegerType()), *(T.StructField(n, T.StringType()) for n in ("email", "source", "snippet"))])


@F.pandas_udf(T.ArrayType(_SEEN))
def _observations(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for shown, anchors in batches:
        yield pd.Series([_observed(t, a) for t, a in zip(shown, anchors)], dtype="object")


def observe_parsed(parsed: DataFrame) -> DataFrame:
    """site_id, seq, ord, page_url, email, source, snippet of pages (site_id, seq, page_url, p: what parse_html gives)."""
    rows = parsed.select("site_id", "seq", "page_url", F.explode(_observations(deobfuscate(F.col("p.email_text")), F.col("p.anchors"))).alias("o"))
    return rows.select("site_id", "seq", "o.ord", "page_url", "o.email", "o.source", "o.snippet")


def observe_pages(pages: DataFrame) -> DataFrame:
    """observe_parsed of pages (site_id, seq, page_url, html)."""
    return observe_parsed(pages.select("site_id", "seq", "page_url", parse_html("html").alias("p")))


def _letters(name: Column) -> Column:
    return F.regexp_replace(text_rules.fold(F.coalesce(name, F.lit(""))), "[^a-z0-9]", "")


def name_bonus(local_part: Column, first_name: Column, last_name: Column) -> Column:
    part, first, last = _letters(local_part), _letters(first_name), _letters(last_name)
    both = (first != "") & (last != "")
    return (
        F.when(both & (part.contains(F.concat(first, last)) | part.contains(F.concat(last, first))), 30)
        .when(both & part.contains(first) & part.contains(last), 25)
        .when((first != "") & part.contains(first), 15)
        .when((last != "") & part.contains(last), 10)
        .otherwise(0)
    )


def domain_bonus(domain: Column, website_url: Column) -> Column:
    host, d = urls.site_host(F.coalesce(website_url, F.lit(""))), F.regexp_replace(F.lower(domain), r"^www\.", "")
    own = (d == host) | d.endswith(F.concat(F.lit("."), host)) | host.endswith(F.concat(F.lit("."), d))
    one, two = F.substring_index(d, ".", 1), F.substring_index(host, ".", 1)
    brand = (F.length(one) >= 8) & (F.length(two) >= 8) & (F.substring(one, 1, 8) == F.substring(two, 1, 8))
    return F.when((host != "") & own, 20).when(brand, 15).when(d.isin(*FREE_DOMAINS), 10).otherwise(-12)


def page_bonus(page_url: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for kv in PAGE_BONUS.items() for x in kv)), urls.url_priority(page_url))


def score(observations: DataFrame, sites: DataFrame) -> DataFrame:
    """site_id, email, score, rank, pages, sources of observations (site_id, page_url, email, source).

    sites: site_id, website_url, first_name, last_name. One aggregation by site and
    address, which combines before its shuffle. A null site_id is a site like others;
    a null page_url is no page.
    """
    priced = observations.select("site_id", "email", "source", F.when(F.col("page_url").isNotNull(), F.struct(urls.url_priority(F.col("page_url")).alias("priority"), F.col("page_url").alias("url"))).alias("page"), page_bonus(F.col("page_url")).alias("bonus"))
    grouped = priced.groupBy("site_id", "email").agg(F.sort_array(F.collect_set("page")).alias("pages"), F.sort_array(F.collect_set("source")).alias("sources"), F.max("bonus").alias("bonus"))
    known = sites.select(F.col("site_id").alias("_site"), "website_url", "first_name", "last_name")
    joined = grouped.join(known, F.col("site_id").eqNullSafe(F.col("_site")), "left").withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("site_id")))
    local, domain = F.substring_index("email", "@", 1), F.substring_index("email", "@", -1)
    named, branded = name_bonus(local, F.col("first_name"), F.col("last_name")), domain_bonus(domain, F.col("website_url"))
    low = F.lit(False)
    for part in LOW_VALUE_PARTS:
        low = low | _letters(local).contains(part)
    raw = (
        F.lit(15)
        + F.when(F.array_contains("sources", "mailto"), 25).otherwise(12)
        + F.col("bonus")
        + named
        + branded
        + F.least(F.lit(10), (F.size("pages") - 1) * 4)
        + F.when(local.isin(*ROLE_PARTS), 6).otherwise(0)
        - F.when(low, 35).otherwise(0)
        + F.when(F.col("n") == 1, 5).otherwise(0)
    )
    sure = (named >= 15) & (branded >= 15)
    scored = joined.withColumn("score", F.greatest(F.lit(0), F.least(F.lit(MOST), F.when(sure, F.greatest(raw, F.lit(MOST))).otherwise(raw))).cast("int"))
    order = Window.partitionBy("site_id").orderBy(F.desc("score"), "email")
    return scored.select("site_id", "email", "score", F.row_number().over(order).alias("rank"), F.transform("pages", lambda p: p["url"]).alias("pages"), "sources")


def evidence(observations: DataFrame) -> DataFrame:
    """site_id, email, evidence: the first distinct lines that say where an address was seen."""
    line = F.concat("source", F.lit(" on "), "page_url", F.lit(": "), "snippet")
    lines = F.sort_array(F.collect_list(F.struct("seq", "ord", line.alias("line"))))
    distinct = F.array_distinct(F.transform(lines, lambda x: x["line"]))
    return observations.groupBy("site_id", "email").agg(F.slice(distinct, 1, EVIDENCE).alias("evidence"))


def summarise(scored: DataFrame) -> DataFrame:
    """site_id, best_email, best_email_score, all_emails, evidence_snippets (JSON, where evidence is there)."""
    kept = scored.filter(F.col("score") >= RETAINED)
    fields = ["email", "score", "pages", "sources"] + (["evidence"] if "evidence" in scored.columns else [])
    in_order = F.sort_array(F.collect_list(F.struct("rank", F.struct(*fields).alias("e"))))
    grouped = kept.groupBy("site_id").agg(in_order.alias("all"))
    top = F.get("all", F.lit(0))["e"]
    good = top["score"] >= BEST
    return grouped.select(
        "site_id",
        F.when(good, top["email"]).alias("best_email"),
        F.when(good, top["score"].cast("double")).alias("best_email_score"),
        F.array_join(F.transform("all", lambda x: x["e"]["email"]), " | ").alias("all_emails"),
        F.to_json(F.transform("all", lambda x: x["e"])).alias("evidence_snippets"),
    )


def enrich(pages: DataFrame, sites: DataFrame) -> DataFrame:
    """enrich_seen of captured pages, each parsed once."""
    return enrich_seen(settled(observe_pages(pages)), sites)


def enrich_seen(seen: DataFrame, sites: DataFrame) -> DataFrame:
    """The e-mail fields of each site from what was observed on its pages; seen is read twice."""
    return summarise(score(seen, sites).join(evidence(seen), ["site_id", "email"]))
