"""Tables in buckets, and averages that grow."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from testbed import catalog
from tests.conftest import DATA
from tests.frames import daily, interruptions, rows, utilization
from upkeep import operators, plans, sinks, sources
from upkeep.sinks import Batches
from upkeep.streaming import averages as growing
from upkeep.streaming import compact_averages, read_averages, update_averages

SF = f"{DATA}/sf0.001"


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def above(plan, mark):
    """For each line of a plan with the mark, the operators above it."""
    lines = [(len(re.match(r"[:+ |-]*", line)[0]), line) for line in plan.splitlines()]
    found = []
    for i, (depth, line) in enumerate(lines):
        if mark in line:
            chain = []
            for outer, text in reversed(lines[:i]):
                if outer < depth:
                    depth = outer
                    chain.append(text)
            found.append(" ".join(chain))
    return found


@pytest.fixture
def large(spark):
    """As for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_buckets_divide_each_other():
    counts = [sinks.bucket_count(n, 10) for n in (0, 1, 10, 11, 20, 21, 1000)]
    assert counts == [1, 1, 1, 2, 2, 4, 128]


@pytest.mark.parametrize("partitions", ["4", "8", "50"])
def test_matrix_from_buckets_shuffles_interruptions_only(spark, large, partitions):
    """Whatever the session's number of shuffle partitions."""
    averages = catalog.keyed(catalog.daily(spark, SF), "daily")
    kpis = catalog.keyed(catalog.utilization(spark, SF), "kpis")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        matrix = plans.build_stored_matrix(averages, kpis, catalog.unscheduled(spark, SF))
        plan = plan_of(matrix)
        assert rows(matrix.drop("average")) == rows(catalog.matrix(spark, SF).drop("average"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    scans = above(plan, "Bucketed: true")
    assert len(scans) == 2
    assert all("SortMergeJoin" in chain and "Exchange" not in chain for chain in scans)
    (others,) = above(plan, "ReadSchema: struct<ts:")
    assert "Exchange hashpartitioning" in others


def test_hot_keys_are_stored_apart(spark, large):
    averages = daily(spark, [("a", "2024-01-01", 1.0), ("b", "2024-01-01", 2.0), ("h", "2024-01-01", 3.0)])
    some = [("a", "2024-01-01", 1, 1, 1), ("c", "2024-01-01", 1, 1, 1)]
    loose = [(None, "2024-01-01", 1, 1, 1), ("a", None, 1, 1, 1)]
    kpis = utilization(spark, some + loose + [("h", "2024-01-01", i % 3, 1, 1) for i in range(30)])
    stored = catalog.keyed(kpis, "kpis", rows_per_piece=10)
    assert stored.hot_keys == 1 and rows(stored.rows()) == rows(kpis)
    assert stored.bucketed.count() == 2 and stored.loose.count() == 32
    left = catalog.keyed(averages, "averages")
    joined = operators.join_keyed(left.bucketed, stored)
    plan = plan_of(joined)
    assert rows(joined) == rows(averages.join(kpis, ["asset_id", "day"]))
    assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 2
    labelled = plans.build_stored_matrix(left, stored, interruptions(spark, [("h", "2024-01-03")]))
    expected = plans.build_matrix(averages, kpis, interruptions(spark, [("h", "2024-01-03")]))
    assert rows(labelled) == rows(expected) and labelled.count() == 31


def test_stored_tables_may_be_empty_or_written_again(spark, tmp_path):
    path = f"file://{tmp_path}/kpis"
    sinks.write_keyed(utilization(spark, []), path, 4)
    assert sources.read_keyed(spark, path).rows().count() == 0
    again = utilization(spark, [("a", "2024-01-01", 1, 2, 3)])
    sinks.write_keyed(again, path, 2)
    stored = sources.read_keyed(spark, path)
    assert stored.buckets == 2 and rows(stored.rows()) == rows(again)


@pytest.mark.parametrize("match", ["pair", "independent"])
def test_other_numbers_of_buckets_give_the_same_rows(spark, large, match, tmp_path):
    for name, frame, n in (("d", catalog.daily(spark, SF), 16), ("u", catalog.utilization(spark, SF), 4)):
        sinks.write_keyed(frame, f"file://{tmp_path}/{name}", n)
    stored = [sources.read_keyed(spark, f"file://{tmp_path}/{name}") for name in "du"]
    got = plans.build_stored_matrix(*stored, catalog.unscheduled(spark, SF), match=match)
    assert rows(got.drop("average")) == rows(catalog.matrix(spark, SF, match=match).drop("average"))


# Averages of growing directories. Values are quarters, whose sums are exact.

HEADER = "date;series;value\n"


@pytest.fixture
def folder(tmp_path):
    place = tmp_path / "sensors"
    place.mkdir()

    def write(name, *lines):
        (place / name).write_text(HEADER + "".join(f"{line}\n" for line in lines))

    write.path = str(place)
    write.out, write.progress = f"file://{tmp_path}/averages", f"file://{tmp_path}/seen"
    return write


def run(spark, folder, **settings):
    query = update_averages(spark, folder.path, folder.out, folder.progress, **settings)
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def same_as_at_once(spark, folder, **settings):
    stored = read_averages(spark, folder.out).select("asset_id", "day", "average")
    full = operators.daily_average(sources.read_readings(spark, folder.path), **settings)
    assert rows(stored) == rows(full)


def test_only_new_files_are_read(spark, folder):
    folder("1-AB0001.csv", "2024-01-01 10:00:00;s;1", "2024-01-01 11:00:00;s;2.5", "2024-02-01 10:00:00;s;1")
    folder("1-AB0002.csv", "2024-01-01 10:00:00;t;x", "oops", "2024-01-02 10:00:00;t;4")
    assert run(spark, folder) == 6
    same_as_at_once(spark, folder)
    assert run(spark, folder) == 0
    # New days, late readings of old days, another asset, and an old file copied in late.
    folder("2-AB0001.csv", "2024-01-01 12:00:00;s;0.25", "2024-03-01 10:00:00;s;9")
    folder("2-AB0003.csv", "2024-01-01 10:00:00;s;7")
    import os

    os.utime(f"{folder.path}/2-AB0003.csv", (1_000_000_000, 1_000_000_000))
    assert run(spark, folder) == 3
    same_as_at_once(spark, folder)
    assert len(Batches(spark, folder.out).committed()) == 2


def test_files_are_taken_a_few_at_a_time_and_by_series(spark, folder):
    for i in range(5):
        folder(f"{i}-AB0001.csv", f"2024-01-0{1 + i % 2} 10:00:00;s;{i}.5", f"2024-01-01 10:00:00;t;{i}")
    assert run(spark, folder, files_per_batch=2, series="s") == 10
    assert len(Batches(spark, folder.out).committed()) == 3
    same_as_at_once(spark, folder, series="s")


def test_merged_batches_count_in_place_of_theirs(spark, folder):
    for i in range(3):
        folder(f"{i}-AB0001.csv", f"2024-01-0{1 + i % 2} 10:00:00;s;{i}.5", ";s;3", "2024-01-09 00:00:00;s;")
        run(spark, folder)
    assert compact_averages(spark, folder.out)
    assert list(Batches(spark, folder.out).committed()) == [(0, 2)]
    assert not compact_averages(spark, folder.out)
    same_as_at_once(spark, folder)
    folder("9-AB0001.csv", "2024-01-01 10:00:00;s;0.75")
    run(spark, folder)
    assert list(Batches(spark, folder.out).committed()) == [(0, 2), (3, 3)]
    same_as_at_once(spark, folder)


def test_a_run_that_breaks_off_is_taken_up(spark, folder, monkeypatch):
    """Before its commit a batch is not seen; after it, it is not stored twice."""
    folder("1-AB0001.csv", "2024-01-01 10:00:00;s;1")
    run(spark, folder)
    folder("2-AB0001.csv", "2024-01-01 10:00:00;s;2")
    seen = rows(read_averages(spark, folder.out))
    plain = Batches.write

    def breaks(when):
        def write(self, *args, **settings):
            if when == "before":
                rows_, batch_id, *_ = args
                rows_.write.parquet(f"{self.path}/batch_id={batch_id}/attempt={'0' * 32}")
            else:
                plain(self, *args, **settings)
            raise RuntimeError("lost")

        return write

    monkeypatch.setattr(Batches, "write", breaks("before"))
    with pytest.raises(Exception, match="lost"):
        run(spark, folder)
    assert rows(read_averages(spark, folder.out)) == seen
    monkeypatch.setattr(Batches, "write", breaks("after"))
    with pytest.raises(Exception, match="lost"):
        run(spark, folder)
    same_as_at_once(spark, folder)
    monkeypatch.setattr(Batches, "write", plain)
    assert run(spark, folder) == 0  # the same batch again, which counts already
    same_as_at_once(spark, folder)
    assert list(Batches(spark, folder.out).committed()) == [(0, 0), (1, 1)]


def test_stored_averages_prune_months(spark, folder):
    folder("1-AB0001.csv", "2024-01-01 10:00:00;s;1", "2024-02-01 10:00:00;s;2")
    run(spark, folder)
    read = read_averages(spark, folder.out)
    asked = operators.take_requests(
        sources.read_requests(spark.createDataFrame([("2024-02-01", "AB0001")], "timeid string, aircraftid string"))
    )
    found = operators.for_requests(read, asked)
    assert [(r.day, r.average) for r in found.collect()] == [(datetime.date(2024, 2, 1), 2.0)]
    assert re.search(r"PartitionFilters: \[[^]]*month", plan_of(found))
    plan = plan_of(read.filter(F.col("day") == "2024-02-01"))
    assert "EqualTo(day,2024-02-01)" in plan


def test_nothing_stored_yet(spark, folder):
    assert read_averages(spark, folder.out).collect() == []
    assert not Batches(spark, folder.out).exists()
    assert not compact_averages(spark, folder.out)
    assert growing.read_averages(spark, folder.out).columns == ["asset_id", "day", "month", "average"]
