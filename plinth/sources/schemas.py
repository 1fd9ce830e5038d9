"""Schemas of the engine's tables, and fitting a frame to one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {"int": T.IntegerType, "string": T.StringType, "boolean": T.BooleanType, "double": T.DoubleType, "timestamp": T.TimestampType}


def _schema(text: str) -> T.StructType:
    """Names and types, comma-separated; needs no session, so that workers can import it."""
    pairs = (field.split() for field in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]()) for name, kind in pairs])


PROFILES = _schema(
    """id int, directory string, source_profile_id string, profile_id string, profile_url string,
    source_state string, source_city string, all_specialties string, best_specialty string, client_focus string,
    website_url string, destination_type string, website_scrape_eligible boolean, phone_number string,
    best_email string, best_email_score double, all_emails string, website_best_specialty string,
    website_all_specialties string, category string, category_source string, created_at timestamp,
    profile_scraped_at timestamp, website_scraped_at timestamp, client_focus_primary string,
    client_focus_secondary string, insurance_details string, payment_category string, fee_raw string,
    fee_clean string, availability_status string, number_of_cities_served int, service_area_cities string,
    first_name string, last_name string, evidence_snippets string, all_pages_text string,
    profile_scrape_status string, profile_scrape_attempts int, profile_scrape_last_error string,
    pt_website_redirect string, website_resolution_status string, website_resolution_attempts int,
    website_resolution_last_error string, website_resolved_at timestamp, website_scrape_status string,
    website_scrape_attempts int, website_scrape_last_error string, profile_is_processing boolean,
    website_redirect_url_is_processing boolean, website_is_processing boolean, category_score double,
    category_evidence string"""
)
RUNS = _schema(
    """id int, directory string, start_url string, target_profile int, max_pages int, pages_completed int,
    unique_profile int, last_completed_page_url string, next_page_url string, status string, last_error string,
    created_at timestamp, completed_at timestamp"""
)
RESOURCES = _schema(
    """id int, proxy_url string, is_active boolean, is_in_use boolean, times_used int, last_used_at timestamp,
    last_checked_at timestamp, lease_token string, lease_until timestamp"""
)
RUN_STATUSES = ("running", "completed", "failed", "pending")


def fit(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df with the schema's columns in its order, missing ones null: what a migration amounts to here."""
    there = set(df.columns)
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in there else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))


def bad_runs(runs: DataFrame) -> DataFrame:
    return runs.filter(~F.coalesce(F.col("status").isin(*RUN_STATUSES), F.lit(False)))


def bad_resources(resources: DataFrame) -> DataFrame:
    """Rows that break a constraint: negative use, or a lease that is set in part."""
    on = F.coalesce("is_in_use", F.lit(False))
    whole = on & F.col("lease_token").isNotNull() & F.col("lease_until").isNotNull()
    none = ~on & F.col("lease_token").isNull() & F.col("lease_until").isNull()
    return resources.filter((F.col("times_used") < 0) | ~(whole | none))
