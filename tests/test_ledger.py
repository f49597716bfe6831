import datetime

import pytest
from pyspark.sql import functions as F

from scanlake.functions.times import moment
from scanlake.operators import integrity, ledger as steps, ranking, registering, reports
from scanlake.options import InputOptions
from scanlake.schemas import LEDGER, RESULTS

T0 = datetime.datetime(2024, 1, 1)
NOW = datetime.datetime(2024, 1, 1, 6)


def row(id, status, **more):
    values = {
        "id": id, "file_path": f"/in/{id}.tif", "file_name": f"{id}.tif", "file_size_bytes": 10,
        "status": status, "retry_count": 0, "created_at": T0,
    } | more
    return tuple(values.get(f.name) for f in LEDGER)


def ledger_of(spark, *rows):
    return spark.createDataFrame(list(rows), LEDGER)


def by_id(df):
    return {r["id"]: r for r in df.collect()}


def test_claim_takes_first_by_id_and_never_overlaps(spark):
    ledger = ledger_of(
        spark, row(5, "pending"), row(2, "pending"), row(9, "pending"), row(1, "pending", retry_count=3),
        row(3, "complete"), row(4, "pending"), row(7, "pending"),
    )
    got = by_id(steps.claim_batch(ledger, ["a", "b"], 2, 3, moment(NOW)))
    assert {i: r["worker_id"] for i, r in got.items() if r["status"] == "processing"} == {
        2: "a", 4: "a", 5: "b", 7: "b"
    }
    assert got[2]["started_at"] == NOW and got[9]["status"] == "pending" and got[1]["status"] == "pending"


def test_claims_go_by_id(spark):
    ledger = ledger_of(spark, *[row(i, "pending") for i in range(50, 0, -1)])
    got = {r["id"]: r["worker"] for r in steps.claim_picks(ledger, ["a", "b", "c"], 7, 3).collect()}
    assert got == {i: "abc"[(i - 1) // 7] for i in range(1, 22)}


def test_repeated_outcomes_keep_one_row_per_id(spark):
    ledger = ledger_of(spark, row(1, "processing"), row(2, "processing"))
    outcomes = spark.createDataFrame(
        [(1, None, "/out/a", 2), (1, None, "/out/a", 2), (2, None, "/out/b", 1), (2, "bad", None, None)],
        "id long, error_message string, output_path string, page_count int",
    )
    got = {r["id"]: r["status"] for r in steps.record_outcomes(ledger, outcomes, 3, moment(NOW)).collect()}
    assert got == {1: "complete", 2: "pending"}
    done = steps.mark_complete(ledger, outcomes.where("id = 1"), moment(NOW))
    assert done.count() == 2


def test_stale_reset_is_strict_and_skips_null(spark):
    edge = datetime.datetime(2024, 1, 1, 5)
    ledger = ledger_of(
        spark,
        row(1, "processing", started_at=edge, worker_id="w"),
        row(2, "processing", started_at=edge - datetime.timedelta(microseconds=1), worker_id="w", retry_count=2),
        row(3, "processing", worker_id="w"),
        row(4, "complete", started_at=T0),
    )
    assert steps.stale(ledger, moment(NOW), 60).count() == 1
    got = by_id(steps.reset_stale(ledger, moment(NOW), 60))
    assert [got[i]["status"] for i in (1, 2, 3, 4)] == ["processing", "pending", "processing", "complete"]
    assert (got[2]["retry_count"], got[2]["worker_id"], got[2]["started_at"]) == (3, None, None)
    after = steps.reset_stale(ledger, moment(NOW), 60)
    assert [r["id"] for r in reports.exhausted_pending(after, 3).collect()] == [2]
    assert reports.queue_empty(after, 3).first()["queue_empty"] is True


@pytest.mark.parametrize("before, status, count", [(0, "pending", 1), (1, "pending", 2), (2, "failed", 3)])
def test_error_retries_then_fails(spark, before, status, count):
    ledger = ledger_of(spark, row(1, "processing", retry_count=before, worker_id="w", started_at=T0))
    errors = spark.createDataFrame([(1, "x" * 4001)], "id bigint, error_message string")
    got = steps.mark_error(ledger, errors, 3).first()
    assert (got["status"], got["retry_count"], got["worker_id"], got["started_at"]) == (status, count, None, None)
    assert len(got["error_message"]) == 4000


def test_complete_keeps_old_error(spark):
    ledger = ledger_of(spark, row(1, "processing", error_message="old", worker_id="w", started_at=T0), row(2, "pending"))
    done = spark.createDataFrame([(1, "/out/1", 2)], "id bigint, output_path string, page_count int")
    got = by_id(steps.mark_complete(ledger, done, moment(NOW)))
    r = got[1]
    assert (r["status"], r["completed_at"], r["output_path"], r["page_count"]) == ("complete", NOW, "/out/1", 2)
    assert (r["error_message"], r["worker_id"], r["started_at"]) == ("old", "w", T0)
    assert got[2]["status"] == "pending"


def test_mixed_batch_equals_the_two_steps(spark):
    ledger = ledger_of(spark, *[row(i, "processing", retry_count=i % 3, worker_id="w", started_at=T0) for i in range(6)])
    mixed = spark.createDataFrame(
        [(0, None, "/o/0", 1), (1, "bad", None, None), (2, "bad", None, None), (3, None, "/o/3", 4)],
        "id bigint, error_message string, output_path string, page_count int",
    )
    once = steps.record_outcomes(ledger, mixed, 3, moment(NOW))
    good, bad = mixed.where("error_message is null"), mixed.where("error_message is not null")
    twice = steps.mark_error(steps.mark_complete(ledger, good, moment(NOW)), bad, 3)
    assert by_id(once) == by_id(twice)


def test_reset_failed(spark):
    ledger = ledger_of(spark, row(1, "failed", retry_count=3, error_message="disk full"), row(2, "pending", retry_count=1))
    assert steps.failed(ledger).count() == 1
    got = by_id(steps.reset_failed(ledger))
    assert (got[1]["status"], got[1]["retry_count"], got[1]["error_message"]) == ("pending", 0, None)
    assert got[2]["retry_count"] == 1


def test_progress(spark):
    rows = [row(i, "complete") for i in range(3)] + [row(3, "pending"), row(4, "failed")]
    got = reports.progress(ledger_of(spark, *rows)).first()
    assert (got["total"], got["complete"], got["processing"], got["percent_complete"]) == (5, 3, 0, 60.0)
    empty = reports.progress(spark.createDataFrame([], LEDGER)).first()
    assert (empty["total"], empty["percent_complete"]) == (0, 0.0)


def test_failed_list_is_ordered(spark):
    ledger = ledger_of(spark, row(2, "failed", file_path="/b"), row(1, "failed", file_path="/a"), row(3, "pending"))
    assert [r["file_path"] for r in reports.failed_list(ledger).collect()] == ["/a", "/b"]


def listing(spark, *paths):
    return spark.createDataFrame([(p, n) for n, p in enumerate(paths)], "file_path string, file_size_bytes bigint")


def test_register_is_idempotent(spark):
    ledger = ledger_of(spark, row(41, "complete", file_path="/in/b.tif"))
    files = registering.matching_files(
        listing(spark, "/in/c.tif", "/in/b.tif", "/in/a.TIFF", "/in/c.tif", "/in/d.pdf", "/x/e.tif"),
        InputOptions(root_path="/in"),
    )
    stats = registering.registration_stats(files, ledger).first()
    assert tuple(stats) == (4, 2, 2)
    new = registering.register_files(files, ledger, moment(NOW))
    assert [(r["id"], r["file_path"], r["status"], r["retry_count"]) for r in new.orderBy("id").collect()] == [
        (42, "/in/a.TIFF", "pending", 0), (43, "/in/c.tif", "pending", 0)
    ]
    assert registering.register_files(files, ledger.unionByName(new), moment(NOW)).count() == 0
    assert tuple(registering.registration_stats(files.limit(0), ledger).first()) == (0, 0, 0)


def test_register_into_empty_ledger_starts_at_one(spark):
    new = registering.register_files(listing(spark, "/in/z.tif"), spark.createDataFrame([], LEDGER), moment(NOW))
    assert new.first()["id"] == 1 and new.schema.names == LEDGER.names


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_number_rows_counts_without_gaps(spark, coalesce):
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, coalesce)
    try:
        check_numbers(spark)
    finally:
        spark.conf.set(setting, before)


def check_numbers(spark):
    df = spark.range(0, 20_000).select((F.col("id") * 7919 % 20_011).alias("k"))
    got = ranking.number_rows(df, "k", "n").orderBy("k").collect()
    assert [r["n"] for r in got] == list(range(1, 20_001))


def results_of(spark, *keys):
    return spark.createDataFrame([(i, p, "t", 0.9, 100, "fixed", T0) for i, p in keys], RESULTS)


def test_results_stay_unique(spark):
    old = results_of(spark, (1, 1), (1, 2), (2, 1))
    with pytest.raises(ValueError):
        steps.append_results(old, results_of(spark, (1, 1)))
    assert steps.append_results(old, results_of(spark, (3, 1))).count() == 4
    replaced = steps.append_results(old, results_of(spark, (1, 1)), replace=True)
    assert sorted((r["image_id"], r["page_number"]) for r in replaced.collect()) == [(1, 1), (2, 1)]


def test_integrity(spark):
    ledger = ledger_of(spark, row(1, "complete"), row(2, "pending"))
    results = results_of(spark, (1, 1), (1, 2), (1, 2), (8, 1))
    assert [tuple(r) for r in integrity.duplicate_pages(results).collect()] == [(1, 2, 2)]
    assert [r["image_id"] for r in integrity.orphan_results(results, ledger).collect()] == [8]
    assert integrity.cascade_delete(results, ledger).count() == 3
    assert integrity.image_results(ledger, results).count() == 3
    assert integrity.image_results(ledger, results, keep_empty=True).count() == 4
    integrity.check(ledger, results_of(spark, (1, 1)))
    with pytest.raises(ValueError):
        integrity.check(ledger, results)
