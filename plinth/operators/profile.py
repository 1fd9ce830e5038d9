"""Profile records from profile pages.

The page's tree is read in one Python pass, which gives the texts and items of its
sections; all rules on them are column expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.functions import text, urls
from plinth.functions.html import Node, Page, clean

#: Headings of the sections that are read.
PRACTICE, FINANCES, SPECIALTIES, FOCUS = "My Practice at a Glance", "Finances", "Specialties and Expertise", "Client Focus"
FOCUS_PARTS = ("Age", "Participants", "Communities", "Ethnicity")


class Sections:
    """Elements of a page by the headings above them."""

    def __init__(self, page: Page) -> None:
        self.page, self.nodes = page, page.nodes

    def text(self, node: Node) -> str:
        return clean(self.page.text(node))

    def find(self, begin: int, end: int, tags: tuple[str, ...], title: str) -> int | None:
        wanted = title.casefold()
        return next((i for i in range(begin, end) if self.nodes[i].tag in tags and self.text(self.nodes[i]).casefold() == wanted), None)

    def until(self, begin: int, tags: tuple[str, ...]) -> int:
        return next((i for i in range(begin, len(self.nodes)) if self.nodes[i].tag in tags), len(self.nodes))

    def section(self, title: str) -> tuple[int, int]:
        at = self.find(0, len(self.nodes), ("h2", "h3"), title)
        return (0, 0) if at is None else (at + 1, self.until(at + 1, ("h2",)))

    def texts(self, begin: int, end: int, holds: Callable[[Node], bool]) -> list[str]:
        return [t for n in self.nodes[begin:end] if holds(n) and (t := self.text(n))]

    def section_texts(self, title: str) -> list[str]:
        return self.texts(*self.section(title), lambda n: n.tag in ("h3", "p", "li") or (n.tag == "div" and n.leaf))

    def items(self, title: str, part: str) -> list[str]:
        """List items and attribute spans below the part's h3, up to any heading."""
        at = self.find(*self.section(title), ("h3",), part)
        if at is None:
            return []
        return self.texts(at + 1, self.until(at + 1, ("h2", "h3")), lambda n: n.tag == "li" or (n.tag == "span" and n.attrs.get("data-x", "").startswith("attribute-")))


def read(html: str | None) -> dict:
    page = Page(html or "")
    own = Sections(page)
    head = next((i for i, n in enumerate(page.nodes) if n.tag == "h1"), None)
    title = next((n.attrs.get("content") for n in page.nodes if n.tag == "meta" and n.attrs.get("property") == "og:title"), None)
    links = [n for n in page.nodes if n.tag == "a" and "href" in n.attrs]
    site = next((n.attrs["href"] for n in links if n.attrs.get("data-x") == "website-link"), "")
    name = own.text(page.nodes[head]) if head is not None else ""
    return {
        "page_text": clean(page.text()),
        "name": name or (title.split(",", 1)[0].strip() if title else None),
        "practice": own.section_texts(PRACTICE),
        "finances": own.section_texts(FINANCES),
        "top": own.items(SPECIALTIES, "Top Specialties"),
        "expertise": own.items(SPECIALTIES, "Expertise"),
        "focus": [x for part in FOCUS_PARTS for x in own.items(FOCUS, part)],
        "insurance": own.items(FINANCES, "Insurance"),
        "fees": own.items(FINANCES, "Fees"),
        "description": own.texts(head + 1, own.until(head + 1, ("h2",)), lambda n: n.tag == "p") if head is not None else [],
        "phones": [{"text": own.text(n), "href": n.attrs["href"]} for n in links if n.attrs["href"].startswith("tel:")],
        "site": site.strip(),
    }


_S = T.StringType()
_LISTS = ("practice", "finances", "top", "expertise", "focus", "insurance", "fees", "description")
_PHONE = T.StructType([T.StructField("text", _S), T.StructField("href", _S)])
PARTS = T.StructType(
    [T.StructField("page_text", _S), T.StructField("name", _S), *(T.StructField(n, T.ArrayType(_S)) for n in _LISTS), T.StructField("phones", T.ArrayType(_PHONE)), T.StructField("site", _S)]
)


@F.pandas_udf(PARTS)
def _parts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for htmls in batches:
        yield pd.DataFrame([read(h) for h in htmls], columns=PARTS.names)


def extract(pages: DataFrame) -> DataFrame:
    """The 14 fields of each page (source_profile_id, profile_url, html)."""
    parsed = pages.select("source_profile_id", "profile_url", _parts("html").alias("p"))
    lists = {n: text.unique(F.col(f"p.{n}")) for n in _LISTS}
    joined = {n: F.array_join(lists.pop(n), " ") for n in ("practice", "finances", "description")}
    base = parsed.select("source_profile_id", "profile_url", "p.page_text", "p.name", "p.phones", F.col("p.site").alias("href"), *(c.alias(n) for n, c in {**lists, **joined}.items()))
    listed = text.unique(F.concat("top", "expertise"))
    more = base.select(
        "*",
        F.when(F.size(listed) > 0, listed).otherwise(text.unique(text.specialties_in(F.col("practice")))).alias("specialties"),
        text.unique(text.split_focus(F.col("focus"))).alias("focused"),
        text.joined(F.col("fees")).alias("fee_raw"),
        text.split_name(F.col("name")).alias("names"),
    )
    ranked = text.rank_focus(F.col("focused"), F.col("description"))
    href = F.col("href")
    out = (href == "") | href.startswith("#") | href.startswith("javascript:")
    return more.select(
        "source_profile_id",
        "names.first_name",
        "names.last_name",
        text.phone_number(F.col("phones"), F.col("page_text")).alias("phone_number"),
        F.when(out, urls.UNAVAILABLE).otherwise(urls.join_url(F.col("profile_url"), href)).alias("pt_website_redirect"),
        text.joined(F.col("specialties")).alias("all_specialties"),
        text.best_specialty(F.col("specialties"), F.col("top"), F.col("practice"), F.col("description")).alias("best_specialty"),
        text.joined(F.col("focused")).alias("client_focus"),
        ranked["first"].alias("client_focus_primary"),
        ranked["second"].alias("client_focus_secondary"),
        text.joined(F.col("insurance")).alias("insurance_details"),
        text.payment_category(F.size("insurance") > 0, F.concat("finances", F.lit(" "), "practice")).alias("payment_category"),
        "fee_raw",
        text.first_money(F.coalesce("fee_raw", F.nullif("finances", F.lit("")), F.col("practice"))).alias("fee_clean"),
        text.availability(F.coalesce(F.nullif("practice", F.lit("")), F.col("page_text"))).alias("availability_status"),
    )
