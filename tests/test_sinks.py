import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from testbed import catalog, roles
from testbed.files import write_reading_files
from testbed.scratch import scratch
from tests.conftest import DATA
from tests.frames import daily, day, rows, utilization
from upkeep import plans, sinks, sources
from upkeep.fixed import FEATURES, MATRIX_CSV_SCHEMA, NEGATIVE
from upkeep.operators import join_on_keys
from upkeep.plans.cli import main
from upkeep.streaming import read_scores

SF = f"{DATA}/sf0.001"


def matrix(spark):
    averages = daily(
        spark, [("a", "2024-01-31", 0.1), ("b", "2024-02-01", 1e-7), ("b", "2024-03-01", 1 / 3)]
    )
    kpis = utilization(
        spark,
        [("a", "2024-01-31", 1, 2, 3), ("b", "2024-02-01", 4, 5, 6), ("b", "2024-03-01", 7, 8, 9)],
    )
    return join_on_keys(averages, kpis).withColumn("maintenance", F.lit(NEGATIVE))


def test_matrix_by_month(spark, tmp_path):
    path = str(tmp_path / "matrix")
    for _ in range(2):  # overwrites
        sinks.write_by_month(matrix(spark), path)
    assert sorted(n for n in os.listdir(path) if n.startswith("month")) == [
        "month=2024-01",
        "month=2024-02",
        "month=2024-03",
    ]
    stored = sources.read_matrix(spark, path)
    assert rows(stored.drop("month")) == rows(matrix(spark))
    plan = stored.filter("month = '2024-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_each_month_is_few_files(spark, tmp_path):
    path = str(tmp_path / "matrix")
    sinks.write_by_month(matrix(spark).repartition(8, "asset_id", "day"), path)
    for month in [n for n in os.listdir(path) if n.startswith("month")]:
        assert len([n for n in os.listdir(f"{path}/{month}") if n.endswith(".parquet")]) == 1


def test_csv_has_header_and_columns_in_stored_order(spark, tmp_path):
    path = str(tmp_path / "csv")
    for _ in range(2):
        sinks.write_matrix_csv(matrix(spark).coalesce(1), path)
    part = next(n for n in os.listdir(path) if n.endswith(".csv"))
    with open(f"{path}/{part}") as file:
        assert file.readline().strip() == ",".join(MATRIX_CSV_SCHEMA.names)
    stored = sources.read_matrix_csv(spark, path)
    assert stored.schema == MATRIX_CSV_SCHEMA
    assert rows(stored) == rows(matrix(spark).select(*MATRIX_CSV_SCHEMA.names))


def test_scratch_is_new_and_shared(spark):
    first, second = scratch(spark, "x"), scratch(spark, "x")
    assert first != second
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert shared is None or first.startswith(shared)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "yarn"
        folder = None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(ValueError):
        scratch(Session(), "x")
    Context.master = "local[2]"
    first, second = scratch(Session(), "x"), scratch(Session(), "y")
    assert first.startswith("file:/") and first.rpartition("/")[0] == second.rpartition("/")[0]


@pytest.fixture
def inputs(spark, tmp_path):
    """Sensor files and tables of sf0.001, with their spec files."""
    readings = write_reading_files(
        roles.readings(spark, SF), f"{tmp_path}/readings", F.lpad("asset_id", 6, "0")
    )
    tables = {
        "utilization": roles.utilization_table(spark, SF),
        "interruptions": roles.interruptions_table(spark, SF).withColumn(
            "starttime", F.col("starttime").cast("timestamp")
        ),
        "requests": roles.requests_table(spark, SF),
    }
    specs = {}
    for name, table in tables.items():
        for column in ("aircraftid", "aircraftregistration"):
            if column in table.columns:
                table = table.withColumn(column, F.lpad(column, 6, "0"))
        table.write.parquet(f"{tmp_path}/{name}")
        spec = {"format": "parquet", "path": f"{tmp_path}/{name}"}
        if name == "requests":
            spec["schema"] = "timeid string, aircraftid string"
        specs[name] = f"{tmp_path}/{name}.json"
        with open(specs[name], "w") as file:
            json.dump(spec, file)
    return readings, specs


def test_jobs_hand_over_through_files(spark, inputs, tmp_path):
    readings, specs = inputs
    out = {
        name: f"{tmp_path}/{name}-{uuid.uuid4().hex}"
        for name in ["averages", "matrix", "direct", "csv", "model", "metrics", "m2", "t2",
                     "scores", "streamed", "progress", "report", "preview", "summary", "held", "growing", "seen", "by_key", "kpis", "from_buckets"]
    }
    tables = ["--utilization", specs["utilization"], "--interruptions", specs["interruptions"]]
    tables += ["--subsystem", roles.SUBSYSTEM]
    main(["averages", "--readings", readings, "--out", out["averages"]])
    main(["matrix", "--averages", out["averages"], *tables, "--out", out["matrix"]])
    main(["matrix", "--readings", readings, *tables, "--out", out["direct"]])
    main(["matrix", "--readings", readings, *tables, "--format", "csv", "--out", out["csv"]])

    main(["averages", "--readings", readings, "--out", out["growing"], "--progress", out["seen"]])
    main(["store", "--averages", out["growing"], "--buckets", "4", "--out", out["by_key"]])
    main(["store", "--utilization", specs["utilization"], "--buckets", "4", "--out", out["kpis"]])
    main(["matrix", "--stored-averages", out["by_key"], "--stored-utilization", out["kpis"],
          *tables[2:], "--out", out["from_buckets"]])

    expected = catalog.label_horizon_documented(spark, SF).withColumn(
        "asset_id", F.lpad("asset_id", 6, "0")
    )
    for name in ["matrix", "direct", "from_buckets"]:
        stored = catalog.rounded(sources.read_matrix(spark, out[name]))
        assert rows(stored.select(*expected.columns)) == rows(expected)
    stored = catalog.rounded(sources.read_matrix_csv(spark, out["csv"]))
    assert rows(stored) == rows(expected.select(*stored.columns))

    main(["train", "--matrix", out["matrix"], "--model", out["model"], "--metrics", out["metrics"]])
    main(["train", "--matrix", out["csv"], "--format", "csv", "--model", out["m2"],
          "--metrics", out["t2"]])
    main(["train", "--matrix", out["matrix"], "--model", out["m2"], "--metrics", out["t2"],
          "--fit-indexers-on", "all", "--label-order", "frequencyDesc",
          "--preview", out["preview"], "--summary", out["summary"]])
    assert spark.read.json(out["preview"]).count() == 5
    assert {r["feature"] for r in spark.read.json(out["summary"]).collect()} == set(FEATURES)
    for name in ["metrics", "t2"]:
        found = spark.read.json(out[name]).collect()
        assert {r["metric"] for r in found} == {"accuracy", "test_error", "recall"}

    scoring = ["score", "--requests", specs["requests"], "--utilization", specs["utilization"],
               "--model", out["model"]]
    main([*scoring, "--readings", readings, "--out", out["scores"], "--report", out["report"],
          "--snapshot", out["held"]])
    shown = spark.read.parquet(out["report"])
    assert shown.columns == ["asset_id", "day", "requests", "status", "prediction", "verdict"]
    assert shown.count() == spark.read.parquet(out["scores"]).count()
    main([*scoring, "--averages", out["averages"], "--out", out["streamed"],
          "--stream", out["progress"]])
    columns = ["asset_id", "day", "requested_day", "requests", "status", "verdict"]
    scored = spark.read.parquet(out["scores"]).select(*columns)
    assert scored.filter("status = 'scored'").count() > 0
    assert rows(scored) == rows(read_scores(spark, out["streamed"]).select(*columns))
    assert scored.filter(F.col("day") > day("2024-02-01")).count() == 0


def test_a_run_for_some_months_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "matrix")
    full = matrix(spark)
    sinks.write_by_month(full, path)
    changed = full.withColumn("average", F.lit(7.0))
    sinks.write_by_month(plans.in_months(changed, ["2024-02"]), path, ["2024-02"])
    february = F.col("day").between("2024-02-01", "2024-02-29")
    expected = full.withColumn("average", F.when(february, 7.0).otherwise(F.col("average")))
    assert rows(sources.read_matrix(spark, path).drop("month")) == rows(expected)
    # A month that has no rows any more is emptied; another is refused.
    sinks.write_by_month(full.filter("false"), path, ["2024-03", "2024-04"])
    assert rows(sources.read_matrix(spark, path).drop("month")) == rows(expected.filter("day < '2024-03-01'"))
    with pytest.raises(Exception, match="outside the months"):
        sinks.write_by_month(full, path, ["2024-02"])
    assert rows(sources.read_matrix(spark, path).drop("month")) == rows(expected.filter("day < '2024-03-01'"))
