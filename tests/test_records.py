from datetime import datetime

import pytest

from plinth.operators import export, leases, runs, state
from plinth.sources import files
from plinth.sources.schemas import PROFILES, RESOURCES, RUNS, bad_resources, fit
from plinth.streaming import upserts

NOW = datetime(2024, 1, 1)


def records(spark, rows, columns):
    return fit(spark.createDataFrame(rows, columns), PROFILES)


def test_export_filters(spark):
    df = records(spark, [(3, "a", "x", NOW), (1, "b", "x", NOW), (2, "a", None, datetime(2023, 1, 1))], "id int, source_city string, category string, created_at timestamp")
    ids = lambda **k: [r["id"] for r in export.select_leads(df, ["id"], **k).collect()]
    assert ids() == [1, 2, 3]
    assert ids(source_city="a") == [2, 3]
    assert ids(source_city="a", filters={"source_city": ["b"]}) == [1]
    assert ids(filters={"source_city": []}) == []
    assert ids(filters={"category": None}) == [1, 2, 3]
    assert ids(created_within_hours=24, now=NOW) == [1, 3]
    assert len(export.select_leads(df).columns) == 34
    with pytest.raises(ValueError):
        export.select_leads(df, ["nope"])
    with pytest.raises(ValueError):
        export.select_leads(df, created_since=NOW, created_within_hours=1, now=NOW)
    with pytest.raises(ValueError):
        export.select_leads(df, created_within_hours=-1, now=NOW)


def test_upsert_last_wins_and_requeues(spark):
    base = records(spark, [("PT:1", "completed", "Jo")], "source_profile_id string, profile_scrape_status string, first_name string")
    found = spark.createDataFrame([("1", "u1", "c", "s", 1), ("1", "u2", "c", "s", 2), ("2", "u", "c", "s", 3), ("", "u", "c", "s", 4)], "profile_id string, profile_url string, source_city string, source_state string, seq int")
    got = {r["source_profile_id"]: (r["profile_url"], r["profile_scrape_status"], r["first_name"]) for r in state.save_profiles(base, found).collect()}
    assert got == {"PT:1": ("u2", "pending", "Jo"), "PT:2": ("u", "pending", None)}


def test_patch_checks_fields(spark):
    base = records(spark, [("PT:1", "x")], "source_profile_id string, category string")
    values = spark.createDataFrame([("PT:1", None)], "source_profile_id string, category string")
    assert state.patch(base, values).first()["category"] == "x"
    with pytest.raises(ValueError):
        state.complete_websites(base, values.withColumnRenamed("category", "website_url"), NOW)


def test_resolution_checks(spark):
    base = records(spark, [("PT:1", True)], "source_profile_id string, website_redirect_url_is_processing boolean")
    bad = spark.createDataFrame([("PT:1", " ", "directory")], "source_profile_id string, website_url string, destination_type string")
    with pytest.raises(Exception):
        state.complete_resolutions(base, bad, NOW).collect()
    good = spark.createDataFrame([("PT:1", " https://a.test ", "directory")], bad.schema)
    row = state.complete_resolutions(base, good, NOW).first()
    assert row["website_url"] == "https://a.test" and row["website_scrape_eligible"] is False and row["website_scrape_status"] is None


def test_sentinel_does_not_queue(spark):
    base = records(spark, [("PT:1", "__unavailable__"), ("PT:2", "https://x"), ("PT:3", "")], "source_profile_id string, pt_website_redirect string")
    done = state.complete_profiles(base, base.select("source_profile_id"), NOW)
    assert {r["source_profile_id"]: r["website_resolution_status"] for r in done.collect()} == {"PT:1": None, "PT:2": "pending", "PT:3": None}


def test_third_failure_is_final(spark):
    base = records(spark, [("PT:1", 2), ("PT:2", 3)], "source_profile_id string, profile_scrape_attempts int")
    failed = state.fail(base, base.selectExpr("source_profile_id", "'x' error"), state.PROFILE)
    assert {r["source_profile_id"]: r["profile_scrape_status"] for r in failed.collect()} == {"PT:1": "pending", "PT:2": "failed"}


def test_claims_need_eligible_websites(spark):
    base = records(spark, [(1, "PT:1", "pending", True, "u", False), (2, "PT:2", "pending", True, None, False), (3, "PT:3", "pending", None, "u", False), (4, "PT:4", "pending", True, "u", None)], "id int, source_profile_id string, website_scrape_status string, website_scrape_eligible boolean, website_url string, website_is_processing boolean")
    assert [r["id"] for r in state.claim(base, state.WEBSITE, 5).filter("website_scrape_attempts = 1").collect()] == [1]


def pool(spark, rows):
    return fit(spark.createDataFrame(rows, "id int, is_active boolean, is_in_use boolean, times_used int, lease_token string, lease_until timestamp"), RESOURCES)


def test_leases(spark):
    rows = [(1, True, True, 0, "a", datetime(2023, 12, 31)), (2, True, False, 1, None, None), (3, False, False, 0, None, None), (4, True, True, 0, "b", datetime(2024, 1, 2))]
    p = pool(spark, rows)
    got = {r["id"]: r["lease_token"] for r in leases.acquire(p, ["x", "y", "z"], NOW).collect()}
    assert got == {1: "x", 2: "y", 3: None, 4: "b"}
    assert leases.release(p, "stale", NOW).exceptAll(p).count() == 0
    renewed = {r["id"]: r["lease_until"] for r in leases.renew(leases.renew(p, "a", NOW), "b", NOW).collect()}
    assert renewed[1] == datetime(2024, 1, 1, 0, 5) and renewed[4] == datetime(2024, 1, 2, 0, 5)
    assert [r["id"] for r in leases.available(p).collect()] == [2]
    assert bad_resources(p).count() == 0


def test_reconcile_counts_and_repeats(spark):
    have = spark.createDataFrame([("a", True), ("b", False), ("c", True)], "proxy_url string, is_active boolean")
    listed = spark.createDataFrame([("b", True), ("c", False), ("d", False), ("d", False)], have.schema)
    assert tuple(leases.counts(leases.reconcile(have, listed)).first()) == (1, 2, 1)


def test_runs(spark):
    empty = spark.createDataFrame([], RUNS)
    one = runs.start(empty, 1, "d", "u", 10, 2, NOW)
    two = runs.start(one, 2, "d", "u", 10, 2, datetime(2023, 1, 1))
    ended = runs.finish(two, 2, "failed", NOW, "x")
    assert runs.resumable(ended, run_id=2).first()["id"] == 1  # what runs comes first, whatever is asked for
    assert runs.resumable(runs.finish(ended, 1, "pending", NOW)).first()["id"] == 2
    assert runs.finish(ended, 1, "pending", NOW).filter("id = 1").first()["completed_at"] is None
    with pytest.raises(LookupError):
        runs.update(ended, 9, status="failed")


def test_resource_csv(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_bytes("﻿proxy_id,proxy_url,enabled\n1, http://u:p@h.test:1 ,\n2,http://u:p@h.test:2,Off\n3,,yes\n".encode())
    assert sorted(map(tuple, files.read_resources(spark, str(path)).drop("position").collect())) == [("http://u:p@h.test:1", True), ("http://u:p@h.test:2", False)]
    path.write_text("proxy_url,enabled\nhttp://h.test:1,maybe\n")
    with pytest.raises(Exception):
        files.read_resources(spark, str(path)).collect()
    path.write_text("url\nx\n")
    with pytest.raises(ValueError):
        files.read_resources(spark, str(path))


def test_export_file(spark, tmp_path):
    df = records(spark, [(1, "a,\"b\"", None)], "id int, source_city string, category string")
    _, n, cols = export.download(df, str(tmp_path / "o"), columns=["id", "source_city", "category"])
    data = next((tmp_path / "o").glob("part-*.csv")).read_bytes().decode("utf-8-sig")
    assert (n, cols) == (1, ["id", "source_city", "category"]) and data == 'id,source_city,category\n1,"a,""b""",\n'


def test_streamed_upserts(spark, tmp_path):
    rows = spark.createDataFrame([("1", "u1", "c", "s", 1), ("1", "u2", "c", "s", 2)], "profile_id string, profile_url string, source_city string, source_state string, seq int")
    rows.write.parquet(str(tmp_path / "in"))
    kept = {"now": fit(spark.createDataFrame([], "source_profile_id string"), PROFILES)}
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))

    def write(df, number):
        df.write.mode("overwrite").parquet(str(tmp_path / f"s{number}"))
        kept["now"] = spark.read.parquet(str(tmp_path / f"s{number}"))

    query = upserts.snapshots(stream, lambda: kept["now"], write, str(tmp_path / "c"))
    query.processAllAvailable()
    query.stop()
    assert [r["profile_url"] for r in kept["now"].collect()] == ["u2"]


def test_the_last_listing_of_a_key_counts(spark):
    have = spark.createDataFrame([("a", False), ("b", True)], "proxy_url string, is_active boolean")
    listed = spark.createDataFrame([("a", False, 2), ("a", True, 3), ("b", False, 9), ("b", True, 1)], "proxy_url string, is_active boolean, position int")
    assert sorted(map(tuple, leases.reconcile(have, listed).collect())) == [("a", True, "reactivated"), ("b", False, "deactivated")]
    in_order = spark.createDataFrame([("a", True), ("a", False)], "proxy_url string, is_active boolean").coalesce(1)
    assert leases.reconcile(have, in_order).filter("proxy_url = 'a'").first()["is_active"] is False


def test_append_and_find(spark, tmp_path):
    df = records(spark, [(1, "a"), (2, "b")], "id int, source_city string")
    files.append(df, str(tmp_path / "t"))
    files.append(df.filter("id = 2"), str(tmp_path / "t"))
    assert [r["id"] for r in export.find(spark.read.parquet(str(tmp_path / "t")), source_city="b").collect()] == [2, 2]
