"""Text rules of profile records as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plinth.functions.urls import let

# Phrases that tell how clients pay and whether they are taken.
SELF_PAY_TERMS = (
    "out of network", "out-of-network", "self pay", "self-pay", "private pay", "cash pay", "cash-pay",
    "superbill", "out of pocket", "out-of-pocket",
)
NO_INSURANCE = ("no insurance", "do not accept insurance")
WAITLIST = ("waitlist", "wait list")
CLOSED = ("not accepting new clients", "unable to accept new clients", "not currently accepting clients")

# Patterns of amounts, of telephone numbers (whose digits are ASCII alone, as \d is here), and of a list of specialties.
# White space is named, for \s takes in a vertical tab here and not in SQL; a record's texts have single spaces only.
MONEY = r"\$[\t\n\f\r ]?[0-9,]+(?:[\t\n\f\r ]*(?:-|–|to)[\t\n\f\r ]*\$?[\t\n\f\r ]?[0-9,]+)?"
PHONE = r"(?:\+1[\t\n\f\r ]*)?\(?[0-9]{3}\)?[-.\t\n\f\r ][0-9]{3}[-.\t\n\f\r ][0-9]{4}"
SPECIALIZE = r"(?i)I specialize in\s+(.+?)(?:\.|I accept|I see|$)"


def fold(text: Column) -> Column:
    """Lower case with ß as ss."""
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def collapse(text: Column) -> Column:
    """White space as single spaces, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def any_in(text: Column, phrases: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in phrases:
        out = out | text.contains(p)
    return out


def occurrences(text: Column, phrase: Column) -> Column:
    """How often phrase occurs in text without overlap; 0 for an empty phrase."""
    gone = F.length(text) - F.length(F.replace(text, phrase))
    return F.when(F.length(phrase) > 0, (gone / F.length(phrase)).cast("int")).otherwise(0)


def unique(items: Column) -> Column:
    """Cleaned items, the first spelling of each; empty ones go."""
    clean = F.filter(F.transform(items, lambda x: F.btrim(collapse(x), F.lit(" ,"))), lambda x: x != "")
    folded = F.transform(clean, fold)
    return F.filter(clean, lambda x, i: F.array_position(folded, F.get(folded, i)) == i + 1)


def joined(items: Column) -> Column:
    """Unique items with bars between, or null."""
    u = unique(items)
    return F.when(F.size(u) > 0, F.array_join(u, " | "))


def first_money(text: Column) -> Column:
    return F.nullif(F.regexp_replace(F.regexp_extract(text, MONEY, 0), r"(?U)\s+", ""), F.lit(""))


def first_phone(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, PHONE, 0), F.lit(""))


def digits(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"(?U)\D", ""))


def phone_number(links: Column, page_text: Column) -> Column:
    """Of tel: links (text, href): the first label with seven digits, or address with as many, in order; else the page's first number."""
    each = F.transform(
        links,
        lambda a: F.when(digits(a["text"]) >= 7, a["text"]).when(
            digits(a["href"]) >= 7, F.regexp_replace(F.coalesce(F.try_url_decode(F.replace(a["href"], F.lit("+"), F.lit("%2B"))), a["href"]), "^tel:", "")
        ),
    )
    return F.coalesce(F.get(F.filter(each, lambda x: x.isNotNull()), F.lit(0)), first_phone(page_text))


def split_name(name: Column) -> Column:
    """struct(first_name, last_name)."""
    parts = F.filter(F.split(collapse(F.coalesce(name, F.lit(""))), " "), lambda x: x != "")
    rest = F.array_join(F.slice(parts, 2, 1 << 30), " ")
    return F.struct(F.get(parts, F.lit(0)).alias("first_name"), F.nullif(rest, F.lit("")).alias("last_name"))


def specialties_in(practice: Column) -> Column:
    """What follows "I specialize in", parted at commas and the word and."""
    found = F.regexp_extract(practice, SPECIALIZE, 1)
    return F.filter(F.transform(F.split(found, r",|\band\b"), lambda x: F.trim(x)), lambda x: x != "")


def best_specialty(items: Column, top: Column, practice: Column, description: Column) -> Column:
    """The item with the highest score of occurrences and rank; of equals the first."""
    folded = F.struct(fold(practice).alias("p"), fold(description).alias("d"), F.transform(top, fold).alias("tops"))

    def best(t: Column) -> Column:
        def scored(x: Column, i: Column) -> Column:
            def of(phrase: Column) -> Column:
                # of repeated spellings the last place counts
                at = F.size(t["tops"]) - F.array_position(F.reverse(t["tops"]), phrase)
                rank = F.when(F.array_contains(t["tops"], phrase), 20 - at).otherwise(0)
                return occurrences(t["p"], phrase) * 5 + occurrences(t["d"], phrase) * 2 + rank

            return F.struct(let(fold(x), of).alias("s"), (-i).alias("i"), x.alias("x"))

        return F.array_max(F.transform(items, scored))["x"]

    return let(folded, best)


def split_focus(items: Column) -> Column:
    parts = F.flatten(F.transform(items, lambda x: F.transform(F.split(x, ","), lambda y: F.btrim(y, F.lit(" ,")))))
    return F.filter(parts, lambda x: x != "")


def rank_focus(items: Column, description: Column) -> Column:
    """struct(first, second): items by occurrences, of equals in their order."""

    def ranked(d: Column) -> Column:
        by = F.transform(items, lambda x, i: F.struct(let(fold(x), lambda phrase: occurrences(d, phrase)).alias("n"), (-i).alias("i"), x.alias("x")))
        return let(F.reverse(F.array_sort(by)), lambda r: F.struct(F.get(r, F.lit(0))["x"].alias("first"), F.get(r, F.lit(1))["x"].alias("second")))

    return let(fold(description), ranked)


def payment_category(insured: Column, text: Column) -> Column:
    """insured: whether insurers are listed; text: finances and practice. Null if text is empty and nothing is listed."""
    t = fold(text)
    accepts = insured | t.contains("accept insurance")
    return (
        F.when(any_in(t, NO_INSURANCE), "self_pay")
        .when(accepts & any_in(t, SELF_PAY_TERMS), "hybrid")
        .when(accepts, "insurance_only")
        .when(t != "", "self_pay")
    )


def availability(text: Column) -> Column:
    t = fold(F.coalesce(text, F.lit("")))
    return F.when(any_in(t, WAITLIST), "waitlist").when(any_in(t, CLOSED), "not_accepting_new_clients").otherwise("accepting_new_clients")
