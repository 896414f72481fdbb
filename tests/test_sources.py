import datetime

import pytest

from tests.frames import day, rows
from upkeep import sources
from upkeep.fixed import UNSCHEDULED_KINDS

HEADER = "date;series;value\n"
LINE = "2024-01-01 10:00:00;s;1.5\n"


@pytest.fixture
def folder(tmp_path):
    def write(name, *lines):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(HEADER + "".join(lines))
        return str(tmp_path)

    return write


def test_only_csv_files_directly_inside(spark, folder):
    for name in ["AB1234.csv", "UP.CSV", "_x.csv", "notes.txt", "sub/CD1234.csv"]:
        path = folder(name, LINE)
    assert rows(sources.read_readings(spark, path).select("asset_id", "value")) == [("AB1234", 1.5)]


def test_names_become_asset_ids(spark, folder):
    names = ["zz", "flight 7 A+1%z", "x-AB1234", "a b"]
    for name in names:
        path = folder(f"{name}.csv", LINE)
    got = sources.read_readings(spark, path).select("asset_id")
    assert rows(got) == sorted((f"{name}.csv"[-10:-4],) for name in names)


def test_bad_fields_become_null_and_rows_stay(spark, folder):
    path = folder(
        "AB1234.csv",
        LINE,
        ";s;2\n",
        "2024-01-01 11:00:00;s;x\n",
        "2024-13-41;s;3\n",
        "broken\n",
        "2024-01-02 00:00:00.000001;t;-1e3\n",
    )
    read = sources.read_readings(spark, path, reject="raw")
    got = {(str(r["date"]), r["series"], r["value"], r["raw"]) for r in read.collect()}
    assert got == {
        ("2024-01-01 10:00:00", "s", 1.5, None),
        ("None", "s", 2.0, None),
        ("2024-01-01 11:00:00", "s", None, "2024-01-01 11:00:00;s;x"),
        ("None", "s", 3.0, "2024-13-41;s;3"),
        ("None", None, None, "broken"),
        ("2024-01-02 00:00:00.000001", "t", -1000.0, None),
    }
    assert sources.read_readings(spark, path).count() == 6


def test_empty_directory_gives_an_empty_typed_frame(spark, tmp_path):
    read = sources.read_readings(spark, str(tmp_path))
    assert read.count() == 0
    assert read.dtypes == [
        ("asset_id", "string"),
        ("date", "timestamp"),
        ("series", "string"),
        ("value", "double"),
    ]


def test_several_directories_are_one_scan(spark, tmp_path):
    for name in ["a", "b"]:
        (tmp_path / name).mkdir()
        (tmp_path / name / "AB1234.csv").write_text(HEADER + LINE)
    both = sources.read_readings(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert both.count() == 2
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
    assert sources.union_readings([both, both.select(*reversed(both.columns))]).count() == 4


class RecordingReader:
    """Stands in for ``spark.read``: no database is started for tests."""

    def __init__(self, result):
        self.result = result
        self.seen = {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen["options"] = options
        return self

    def load(self):
        return self.result


class Session:
    def __init__(self, reader):
        self.read = reader


def test_jdbc_takes_the_callers_connection_and_splits_the_read(spark):
    table = spark.createDataFrame([("a", 1, 2)], "aircraftid string, other int, more int")
    reader = RecordingReader(table)
    connection = {"url": "jdbc:postgresql://db/x", "driver": "d", "user": "u"}
    read = sources.read_source(
        Session(reader),
        {
            "format": "jdbc",
            "options": connection,
            "table": "public.t",
            "partitioning": {
                "column": "timeid",
                "lower": datetime.date(2020, 1, 1),
                "upper": "2024-01-01",
                "partitions": 64,
            },
        },
    )
    assert read is table
    assert reader.seen == {
        "format": "jdbc",
        "options": {
            **connection,
            "dbtable": "public.t",
            "partitionColumn": "timeid",
            "lowerBound": "2020-01-01",
            "upperBound": "2024-01-01",
            "numPartitions": "64",
        },
    }
    projected = sources.read_jdbc(
        Session(reader), connection, "t", ["aircraftid"], one_task=True
    )
    assert projected.columns == ["aircraftid"]
    assert reader.seen["options"] == {**connection, "dbtable": "t"}


def test_jdbc_in_one_task_must_be_asked_for(spark):
    table = spark.createDataFrame([("a", 1)], "aircraftid string, other int")
    spec = {"format": "jdbc", "options": {"url": "jdbc:postgresql://db/x"}, "table": "t"}
    with pytest.raises(ValueError):
        sources.read_source(Session(RecordingReader(table)), spec)
    reader = RecordingReader(table)
    assert sources.read_source(Session(reader), {**spec, "one_task": True}) is table
    assert "numPartitions" not in reader.seen["options"]


def test_utilization_reads_its_columns_only(spark, tmp_path):
    spark.createDataFrame(
        [(day("2024-01-01"), 7, 1, 2.5, 3, "x")],
        "timeid date, aircraftid int, flighthours int, flightcycles double, "
        "delayedminutes int, other string",
    ).write.parquet(str(tmp_path / "t"))
    table = sources.read_source(spark, {"format": "parquet", "path": str(tmp_path / "t")})
    read = sources.utilization_from(table)
    assert rows(read) == [("7", day("2024-01-01"), 1.0, 2.5, 3.0)]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "other" not in plan


def test_interruption_conditions_reach_the_scan(spark, tmp_path):
    stamp = datetime.datetime(2024, 1, 1, 23, 59, 59)
    spark.createDataFrame(
        [
            ("3453", "Delay", stamp, "a"),
            ("3453", "Safety", stamp, "b"),
            ("3453", "AircraftOnGround", stamp, "c"),
            ("3453", "Maintenance", stamp, "d"),
            ("3453", None, stamp, "e"),
            ("9999", "Delay", stamp, "f"),
            (None, "Delay", stamp, "g"),
        ],
        "subsystem string, kind string, starttime timestamp, aircraftregistration string",
    ).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    first = day("2024-01-01")
    counted = sources.interruptions_from(table, "3453", UNSCHEDULED_KINDS)
    assert rows(counted) == [("a", first), ("b", first), ("c", first)]
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(subsystem,3453)" in plan
    assert "In(kind, [AircraftOnGround,Delay,Safety])" in plan
    assert len(rows(sources.interruptions_from(table, "3453"))) == 5
    assert len(rows(sources.interruptions_from(table))) == 7


def test_requests_from_text_dates_and_timestamps(spark):
    text = spark.createDataFrame(
        [("2024-1-5", "a"), ("soon", "a"), (None, "b"), ("2024-01-05", None)],
        "timeid string, aircraftid string",
    )
    fifth = day("2024-01-05")
    assert rows(sources.read_requests(text)) == sorted(
        [
            ("a", fifth, "2024-01-05"),
            ("a", None, "soon"),
            ("b", None, None),
            (None, fifth, "2024-01-05"),
        ],
        key=repr,
    )
    stamps = spark.createDataFrame(
        [(datetime.datetime(2024, 1, 5), 3)], "timeid timestamp, aircraftid int"
    )
    assert rows(sources.read_requests(stamps)) == [("3", fifth, "2024-01-05")]
    assert sources.read_requests(text.limit(0)).count() == 0


def test_days_are_cut_into_parts_of_like_size(spark):
    """Every row is in one part, also one without a day or of a day not counted."""
    first = datetime.date(2024, 1, 1)
    counts = [(first + datetime.timedelta(i), 1 + (i % 7) ** 3) for i in range(100)]
    table = spark.createDataFrame(
        [(d, n) for d, n in counts] + [(None, 5), (datetime.date(2030, 1, 1), 1), (datetime.date(1990, 1, 1), 1)],
        "timeid date, n int",
    )
    for partitions in (1, 2, 7, 500):
        predicates = sources.day_predicates([*counts, (None, 5)], "timeid", partitions)
        assert 1 <= len(predicates) <= min(partitions, 100)
        parts = [rows(table.filter(p)) for p in predicates]
        assert sorted((r for part in parts for r in part), key=repr) == rows(table)
    predicates = sources.day_predicates(counts, "timeid", 7)
    sizes = [sum(n for _, n in map(tuple, table.filter(p).collect())) for p in predicates]
    assert len(sizes) == 7 and max(sizes) < 1.3 * sum(sizes) / 7
    # One day with nearly all rows is a part of its own; an empty table is one part.
    hot = sources.day_predicates([(first, 1), (first + datetime.timedelta(1), 10**6), (first + datetime.timedelta(2), 1)], "t", 3)
    assert "t >= DATE '2024-01-02' AND t < DATE '2024-01-03'" in hot
    assert sources.day_predicates([], "t", 8) == ["1 = 1"]
    assert sources.day_predicates([(first, 9)], "t", 8) == ["1 = 1"]


def test_jdbc_by_day_counts_in_the_database(spark):
    class Reader:
        def __init__(self):
            self.asked = []

        def format(self, name):
            return self

        def options(self, **options):
            self.asked.append(options["dbtable"])
            return self

        def load(self):
            return spark.createDataFrame(
                [(datetime.date(2024, 1, d), 10) for d in (1, 2, 3, 4)], "day date, n bigint"
            )

        def jdbc(self, url, table, predicates, properties):
            self.asked.append((url, table, predicates, properties))
            return "frame"

    class Stand:
        read = Reader()

    spec = {"format": "jdbc", "options": {"url": "jdbc:x", "user": "u"}, "table": "public.t",
            "by_day": {"column": "timeid", "partitions": 2}}
    assert sources.read_source(Stand(), spec) == "frame"
    count, read = Stand.read.asked
    assert count == "(SELECT CAST(timeid AS DATE) AS day, COUNT(*) AS n FROM public.t GROUP BY CAST(timeid AS DATE)) days"
    cut = "DATE '2024-01-03'"
    assert read == ("jdbc:x", "public.t", [f"timeid < {cut} OR timeid IS NULL", f"timeid >= {cut}"], {"user": "u"})
