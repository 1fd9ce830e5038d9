"""Filtered, validated projections of lead records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from plinth.sources.files import write_csv

# The columns that an export has unless told otherwise, in order.
DEFAULT_COLUMNS = (
    "id", "directory", "source_profile_id", "profile_id", "profile_url", "source_state", "source_city", "first_name",
    "last_name", "phone_number", "all_specialties", "best_specialty", "client_focus", "client_focus_primary",
    "client_focus_secondary", "insurance_details", "payment_category", "fee_raw", "fee_clean", "availability_status",
    "number_of_cities_served", "service_area_cities", "website_url", "destination_type", "best_email",
    "best_email_score", "all_emails", "website_best_specialty", "website_all_specialties", "category",
    "category_source", "category_score", "evidence_snippets", "category_evidence",
)
#: Filters that callers may give by name.
NAMED = ("directory", "source_city", "source_state", "profile_scrape_status", "website_resolution_status", "website_scrape_status", "website_scrape_eligible")


def created_after(since: datetime | None, within_hours: int | None, now: datetime | None) -> datetime | None:
    """The one bound on created_at; hours are counted back from now, which callers pass."""
    if since is not None and within_hours is not None:
        raise ValueError("created_since and created_within_hours exclude each other")
    if within_hours is None:
        return since
    if within_hours < 0:
        raise ValueError("created_within_hours is negative")
    if now is None:
        raise ValueError("created_within_hours needs now")
    return now - timedelta(hours=within_hours)


def select_leads(
    leads: DataFrame,
    columns: Sequence[str] | None = None,
    filters: Mapping[str, object] | None = None,
    created_since: datetime | None = None,
    created_within_hours: int | None = None,
    now: datetime | None = None,
    order_by: str = "id",
    created_at: str = "created_at",
    **named: object,
) -> DataFrame:
    """Requested columns in the caller's order, rows that pass every filter, by id.

    A filter of None is left out, a sequence means one of its values (an empty one: no
    row), anything else equality; filters override named ones. Unknown columns are an error.
    """
    wanted = tuple(columns or DEFAULT_COLUMNS)
    if unknown := set(named) - set(NAMED):
        raise TypeError(f"unknown filters: {sorted(unknown)}")
    asked = {**named, **(filters or {})}
    if missing := [c for c in (*wanted, *asked) if c not in leads.columns]:
        raise ValueError(f"unknown columns: {missing}")
    keep = F.lit(True)
    for name, value in asked.items():
        if value is None:
            continue
        several = isinstance(value, Sequence) and not isinstance(value, str | bytes)
        keep = keep & (F.col(name).isin(*value) if several and value else F.lit(False) if several else F.col(name) == value)
    if (bound := created_after(created_since, created_within_hours, now)) is not None:
        keep = keep & (F.col(created_at) >= F.lit(bound))
    return leads.filter(keep).orderBy(order_by).select(*wanted)


def download(leads: DataFrame, path: str, **how) -> tuple[str, int, list[str]]:
    """Writes the selection as CSV; path, rows and columns."""
    seen = Observation()
    rows = select_leads(leads, **how)
    write_csv(rows.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    return path, seen.get["rows"], rows.columns


def find(df: DataFrame, **key: object) -> DataFrame:
    """Rows with these key values."""
    for name, value in key.items():
        df = df.filter(F.col(name) == value)
    return df
