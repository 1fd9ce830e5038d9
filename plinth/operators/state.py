"""Record lifecycles as transformations from one snapshot to the next.

Rows aren't changed in place: a claim, a completion or a failure gives a new snapshot.
One writer per snapshot stands for row locks. Times and numbers of claims are
parameters, so a snapshot depends on its inputs alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions.urls import SOURCE_NAME, UNAVAILABLE


@dataclass(frozen=True)
class Stage:
    """Columns of one lifecycle, and the fields that its completion may set."""

    status: str
    busy: str
    attempts: str
    error: str
    done_at: str
    allowed: tuple[str, ...] = ()


PROTECTED_PROFILE = ("source_profile_id", "id", "profile_scrape_status", "profile_is_processing", "profile_scraped_at")
PROFILE = Stage("profile_scrape_status", "profile_is_processing", "profile_scrape_attempts", "profile_scrape_last_error", "profile_scraped_at")
RESOLUTION = Stage("website_resolution_status", "website_redirect_url_is_processing", "website_resolution_attempts", "website_resolution_last_error", "website_resolved_at")
WEBSITE = Stage(
    "website_scrape_status", "website_is_processing", "website_scrape_attempts", "website_scrape_last_error", "website_scraped_at",
    ("best_email", "best_email_score", "all_emails", "website_best_specialty", "website_all_specialties", "category", "category_source", "evidence_snippets", "category_score", "category_evidence"),
)
MOST_ATTEMPTS = 3
KEY = "source_profile_id"
#: What discovery sets; a known profile becomes pending again.
DISCOVERED = ("directory", "profile_id", "profile_url", "source_city", "source_state", "profile_scrape_status")


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key: one aggregation that combines before the shuffle, so a hot key is no matter."""
    rest = [c for c in rows.columns if c != key]
    last = F.max_by(F.struct(*rest), F.struct(F.col(order), *(F.col(c) for c in rest if c != order))).alias("_r")
    return rows.groupBy(key).agg(last).select(key, "_r.*")


def upsert(base: DataFrame, incoming: DataFrame, key: str, columns: tuple[str, ...]) -> DataFrame:
    """base with columns of incoming (unique keys) set where the key is there, and new rows added."""
    b, i = base.alias("b"), incoming.withColumn("_new", F.lit(True)).alias("i")
    joined = b.join(i, F.col(f"b.{key}") == F.col(f"i.{key}"), "full")
    new = F.col("i._new").isNotNull()
    pick = lambda c: F.coalesce(f"b.{c}", f"i.{c}") if c == key else F.when(new, F.col(f"i.{c}")).otherwise(F.col(f"b.{c}")) if c in columns else F.col(f"b.{c}")
    return joined.select(*(pick(c).alias(c) for c in base.columns))


def save_profiles(base: DataFrame, found: DataFrame) -> DataFrame:
    """base with discovered profiles (profile_id, profile_url, source_city, source_state, seq; the last of a key wins)."""
    some = found.filter(F.coalesce("profile_id", F.lit("")) != "")
    has = lambda c, default: F.coalesce(F.col(c), default) if c in found.columns else default
    full = some.select(
        has(KEY, F.concat(F.lit("PT:"), "profile_id")).alias(KEY),
        has("directory", F.lit(SOURCE_NAME)).alias("directory"),
        "profile_id", "profile_url", "source_city", "source_state",
        has("profile_scrape_status", F.lit("pending")).alias("profile_scrape_status"),
        "seq",
    )
    return upsert(base, latest(full, KEY, "seq").drop("seq"), KEY, DISCOVERED)


def patch(base: DataFrame, values: DataFrame, key: str = KEY, allowed: tuple[str, ...] | None = None, protected: tuple[str, ...] = ()) -> DataFrame:
    """base with values (unique keys) laid over; a null never overwrites. Fields are checked first."""
    names = [c for c in values.columns if c != key]
    if wrong := [c for c in names if c not in base.columns or c in protected or (allowed is not None and c not in allowed)]:
        raise ValueError(f"fields that cannot be set: {wrong}")
    joined = base.alias("b").join(values.alias("v"), F.col(f"b.{key}") == F.col(f"v.{key}"), "left")
    return joined.select(*((F.coalesce(f"v.{c}", f"b.{c}") if c in names else F.col(f"b.{c}")).alias(c) for c in base.columns))


def claimable(rows: DataFrame, stage: Stage, status: str = "pending", since: datetime | None = None, **where: object) -> DataFrame:
    """Rows that a worker may claim."""
    keep = (F.col(stage.status) == status) & (F.col(stage.busy) == F.lit(False))
    if stage is WEBSITE:
        keep = keep & (F.col("website_scrape_eligible") == F.lit(True)) & F.col("website_url").isNotNull()
    if since is not None:
        keep = keep & (F.col("created_at") >= F.lit(since))
    for name, value in where.items():
        if value is not None:
            keep = keep & (F.col(name) == value)
    return rows.filter(keep)


def claim(rows: DataFrame, stage: Stage, n: int, order: str = "id", key: str = KEY, **where) -> DataFrame:
    """rows with the first n claimable ones marked: busy, one attempt more, no error.

    The first n come by a top-n, which keeps n rows a task; n is what workers can take at once.
    """
    taken = claimable(rows, stage, **where).orderBy(order).limit(n).select(F.col(key).alias("_k"), F.lit(True).alias("_claimed"))
    joined = rows.join(taken, F.col(key) == F.col("_k"), "left")
    on = F.col("_claimed").isNotNull()
    change = {stage.busy: F.lit(True), stage.attempts: F.coalesce(F.col(stage.attempts), F.lit(0)) + 1, stage.error: F.lit(None).cast("string")}
    return joined.select(*((F.when(on, change[c]).otherwise(F.col(c)) if c in change else F.col(c)).alias(c) for c in rows.columns))


def _set(rows: DataFrame, on: Column, change: dict[str, Column]) -> DataFrame:
    return rows.select(*((F.when(on, change[c]).otherwise(F.col(c)) if c in change else F.col(c)).alias(c) for c in rows.columns))


def _marked(rows: DataFrame, results: DataFrame) -> tuple[DataFrame, Column]:
    marks = results.select(F.col(KEY).alias("_k")).distinct().withColumn("_on", F.lit(True))
    return rows.join(marks, F.col(KEY) == F.col("_k"), "left").drop("_k"), F.col("_on").isNotNull()


def complete_profiles(rows: DataFrame, values: DataFrame, at: datetime) -> DataFrame:
    """rows with extracted fields; those with an outward link queue for resolution."""
    marked, on = _marked(patch(rows, values, protected=PROTECTED_PROFILE), values)
    link = on & (F.coalesce("pt_website_redirect", F.lit("")) != "") & (F.col("pt_website_redirect") != UNAVAILABLE)
    done = _set(marked, on, {PROFILE.status: F.lit("completed"), PROFILE.busy: F.lit(False), PROFILE.done_at: F.lit(at)})
    return _set(done, link, {RESOLUTION.status: F.lit("pending"), RESOLUTION.error: F.lit(None).cast("string")}).drop("_on")


def complete_resolutions(rows: DataFrame, results: DataFrame, at: datetime) -> DataFrame:
    """rows with results (key, website_url, destination_type); only owned websites queue for scraping."""
    url = F.trim("website_url")
    kind = F.col("destination_type")
    wrong = F.raise_error(F.lit("website_url must not be empty, destination_type be directory or owned_website"))
    fine = (F.coalesce(url, F.lit("")) != "") & F.coalesce(kind.isin("directory", "owned_website"), F.lit(False))
    checked = results.select(KEY, F.when(fine, url).otherwise(wrong.cast("string")).alias("website_url"), "destination_type")
    marked, on = _marked(patch(rows, checked), checked)
    own = F.col("destination_type") == "owned_website"
    done = _set(
        marked, on,
        {"website_scrape_eligible": own, RESOLUTION.status: F.lit("completed"), RESOLUTION.error: F.lit(None).cast("string"), RESOLUTION.busy: F.lit(False), RESOLUTION.done_at: F.lit(at)},
    )
    return _set(done, on & own, {WEBSITE.status: F.lit("pending")}).drop("_on")


def complete_websites(rows: DataFrame, values: DataFrame, at: datetime) -> DataFrame:
    """rows with scraped fields; a scraped website is no longer eligible."""
    marked, on = _marked(patch(rows, values, allowed=WEBSITE.allowed), values)
    change = {WEBSITE.status: F.lit("completed"), WEBSITE.busy: F.lit(False), WEBSITE.error: F.lit(None).cast("string"), WEBSITE.done_at: F.lit(at), "website_scrape_eligible": F.lit(False)}
    return _set(marked, on, change).drop("_on")


def outcome(attempts: Column, most: int = MOST_ATTEMPTS) -> Column:
    """What a failure makes of a row: another turn, or the end."""
    return F.when(F.coalesce(attempts, F.lit(0)) >= most, "failed").otherwise("pending")


def fail(rows: DataFrame, failures: DataFrame, stage: Stage, final: bool | None = None, most: int = MOST_ATTEMPTS) -> DataFrame:
    """rows with failures (key, error) recorded and released.

    final: True fails them, False requeues them, None goes by the number of attempts.
    """
    errors = latest(failures.select(KEY, "error", F.lit(0).alias("_o")), KEY, "_o").select(F.col(KEY).alias("_k"), F.col("error").alias("_e"), F.lit(True).alias("_on"))
    joined = rows.join(errors, F.col(KEY) == F.col("_k"), "left")
    to = outcome(F.col(stage.attempts), most) if final is None else F.lit("failed" if final else "pending")
    return _set(joined, F.col("_on").isNotNull(), {stage.status: to, stage.error: F.col("_e"), stage.busy: F.lit(False)}).select(*rows.columns)


def summary(results: DataFrame) -> DataFrame:
    """claimed, completed, requeued, failed of outcomes (status)."""
    n = lambda s: F.count_if(F.col("status") == s)
    return results.agg(F.count(F.lit(1)).alias("claimed"), n("completed").alias("completed"), n("requeued").alias("requeued"), n("failed").alias("failed"))
