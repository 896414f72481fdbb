"""One query per operator over the driver tables, with its DuckDB twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from testbed import roles
from testbed.files import write_reading_files
from testbed.scratch import scratch
from upkeep import learning, operators, plans, sinks, sources
from upkeep.fixed import (
    AVERAGE,
    FEATURES,
    KEYS,
    KPIS,
    LABEL,
    NEGATIVE,
    POSITIVE,
    UNSCHEDULED_KINDS,
)
from upkeep.functions import key_bucket
from upkeep.streaming import read_averages, read_scores, score_stream, update_averages

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MEASURES = [AVERAGE, *KPIS]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with SQL that must give the same rows."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = with_roles(sql)
        return function

    return register


# The roles of FIXTURES.md in SQL.
ROLES = {
    "readings": """
        SELECT CAST(user_id AS VARCHAR) AS asset_id, ts AS date, event_type AS series, value
        FROM events WHERE event_type IN ('view', 'click')""",
    "daily": """
        SELECT asset_id, CAST(date AS DATE) AS day, avg(value) AS average
        FROM readings GROUP BY 1, 2""",
    "utilization": """
        SELECT CAST(user_id AS VARCHAR) AS asset_id, CAST(ts AS DATE) AS day,
               sum(value) AS flighthours, CAST(count(*) AS DOUBLE) AS flightcycles,
               max(value) AS delayedminutes
        FROM events WHERE hour(ts) < 12 GROUP BY 1, 2""",
    "interruptions": """
        SELECT event_type AS subsystem, CAST(user_id AS VARCHAR) AS asset_id,
               CAST(ts AS DATE) AS start_day,
               CASE WHEN value > 200 THEN 'AircraftOnGround' WHEN value > 150 THEN 'Safety'
                    WHEN value > 100 THEN 'Delay' ELSE 'Other' END AS kind
        FROM events WHERE day(ts) <= 15""",
    "unscheduled": """
        SELECT asset_id, start_day FROM interruptions
        WHERE subsystem = 'error' AND kind IN ('Delay', 'Safety', 'AircraftOnGround')""",
    "errors": """
        SELECT asset_id, start_day FROM interruptions WHERE subsystem = 'error'""",
    "base": """
        SELECT asset_id, day, average, flighthours, flightcycles, delayedminutes
        FROM daily JOIN utilization USING (asset_id, day)""",
    "labelled": """
        SELECT base.*, CASE WHEN EXISTS (
                   SELECT 1 FROM unscheduled u WHERE u.asset_id = base.asset_id
                   AND base.day BETWEEN u.start_day - 7 AND u.start_day)
               THEN 'unscheduled maintenance' ELSE 'no maintenance' END AS maintenance
        FROM base""",
    "labelled_as_coded": """
        SELECT base.*, CASE WHEN
                   EXISTS (SELECT 1 FROM unscheduled u
                           WHERE base.day BETWEEN u.start_day AND u.start_day + 7)
                   AND asset_id IN (SELECT asset_id FROM unscheduled)
               THEN 'unscheduled maintenance' ELSE 'no maintenance' END AS maintenance
        FROM base""",
    "planted": """
        SELECT *, CASE WHEN (flightcycles >= 2) <> (bucket % 10 = 0)
                  THEN 'unscheduled maintenance' ELSE 'no maintenance' END AS maintenance
        FROM (SELECT *, CAST(('0x' || substr(md5(asset_id || '|' || day), 1, 8)) AS BIGINT) % 100 AS bucket
              FROM base)""",
    "rule": """
        SELECT flightcycles >= 2 AS busy,
               CASE WHEN count(*) FILTER (WHERE maintenance = 'unscheduled maintenance')
                         > count(*) FILTER (WHERE maintenance = 'no maintenance')
                    THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
        FROM planted WHERE bucket < 70 GROUP BY 1""",
    "foretold": """
        SELECT planted.*, rule.prediction,
               CASE WHEN maintenance = 'no maintenance' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END
               AS label_index,
               CASE WHEN rule.prediction = 0 THEN 'no maintenance'
                    ELSE 'unscheduled maintenance' END AS verdict
        FROM planted JOIN rule ON rule.busy = (flightcycles >= 2) WHERE bucket >= 70""",
    "requests": """
        SELECT CAST(user_id AS VARCHAR) AS asset_id,
               CASE WHEN value > 100 THEN NULL ELSE CAST(ts AS DATE) END AS day,
               CASE WHEN value > 100 THEN 'about ' ELSE '' END
                   || strftime(ts, '%Y-%m-%d') AS requested_day
        FROM events WHERE event_type = 'purchase'""",
    "status": """
        SELECT r.*, CASE WHEN r.day IS NULL THEN 'invalid_request'
                         WHEN d.average IS NULL THEN 'no_readings'
                         WHEN u.flighthours IS NULL THEN 'no_utilization'
                         ELSE 'scored' END AS status
        FROM (SELECT asset_id, day, requested_day, count(*) AS requests
              FROM requests GROUP BY 1, 2, 3) r
        LEFT JOIN daily d USING (asset_id, day)
        LEFT JOIN utilization u USING (asset_id, day)""",
    "judged": """
        SELECT s.*, average, flighthours, flightcycles, delayedminutes,
               CASE WHEN status = 'scored' THEN prediction END AS prediction,
               CASE WHEN status <> 'scored' THEN NULL WHEN prediction = 0 THEN 'no maintenance'
                    ELSE 'unscheduled maintenance' END AS verdict
        FROM status s LEFT JOIN daily USING (asset_id, day)
        LEFT JOIN utilization USING (asset_id, day)
        LEFT JOIN rule ON rule.busy = (flightcycles >= 2)""",
}

MEASURES_SQL = ", ".join(f"round({name}, 6) AS {name}" for name in MEASURES)


def with_roles(sql: str) -> str:
    """Put the role definitions in front of a query."""
    ctes = ", ".join(f"{name} AS ({body})" for name, body in ROLES.items())
    return f"WITH {ctes} {sql}"


# Inputs in their roles.


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.readings(spark, sf_dir)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.daily_average(readings(spark, sf_dir))


def utilization(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.utilization_from(roles.utilization_table(spark, sf_dir))


def unscheduled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.interruptions_from(
        roles.interruptions_table(spark, sf_dir), roles.SUBSYSTEM, UNSCHEDULED_KINDS
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_requests(roles.requests_table(spark, sf_dir))


def matrix(spark: SparkSession, sf_dir: str, **label: object) -> DataFrame:
    # The utilization in its role is grouped by key, so no key can be hot.
    return plans.build_matrix(
        daily(spark, sf_dir), utilization(spark, sf_dir), unscheduled(spark, sf_dir), **label
    )


def rounded(frame: DataFrame, names: list[str] = MEASURES) -> DataFrame:
    return frame.withColumns({name: F.round(name, 6) for name in names if name in frame.columns})


def stored_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix as the training job finds it."""
    path = scratch(spark, "matrix")
    sinks.write_by_month(matrix(spark, sf_dir), path)
    return sources.read_matrix(spark, path)


_models: dict[tuple[str, str], PipelineModel] = {}


def model(spark: SparkSession, sf_dir: str) -> PipelineModel:
    """The tree for a data directory, trained once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _models:
        _models[key] = learning.train(stored_matrix(spark, sf_dir)).model
    return _models[key]


def planted(frame: DataFrame) -> DataFrame:
    """A label that one split on flightcycles tells, but for every tenth key."""
    busy = F.col("flightcycles") >= 2
    odd = key_bucket() % 10 == 0
    return frame.withColumn(LABEL, F.when(busy != odd, POSITIVE).otherwise(NEGATIVE))


def trained_stump(spark: SparkSession, sf_dir: str) -> learning.Training:
    """A tree of one split, whose predictions SQL can tell from majorities."""
    given = planted(stored_matrix(spark, sf_dir))
    return learning.train(given, max_categories=2, maxDepth=1)


_stumps: dict[tuple[str, str], PipelineModel] = {}


def stump(spark: SparkSession, sf_dir: str) -> PipelineModel:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stumps:
        _stumps[key] = trained_stump(spark, sf_dir).model
    return _stumps[key]


# Scans and sources.


@query(
    """SELECT lpad(asset_id, 6, '0') AS asset_id,
              strftime(date, '%Y-%m-%d %H:%M:%S.%f') AS date, series, value FROM readings"""
)
def scan_readings_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_reading_files(
        readings(spark, sf_dir), scratch(spark, "readings"), F.lpad("asset_id", 6, "0")
    )
    found = sources.read_readings(spark, path)
    return found.withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query(
    """SELECT lpad(asset_id, 6, '0') AS asset_id,
              CASE WHEN hour(date) >= 6 THEN CAST(date AS DATE) END AS day, series,
              CASE WHEN value <= 100 THEN value END AS value,
              value > 100 AS malformed
       FROM readings"""
)
def scan_readings_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Night readings lack their date, values above 100 are no numbers."""
    path = write_reading_files(
        readings(spark, sf_dir),
        scratch(spark, "malformed"),
        F.lpad("asset_id", 6, "0"),
        date=F.when(F.hour("date") >= 6, F.date_format("date", "yyyy-MM-dd HH:mm:ss")),
        value=F.when(F.col("value") <= 100, F.col("value").cast("string")).otherwise("n/a"),
    )
    return sources.read_readings(spark, path, reject="raw").select(
        "asset_id",
        F.to_date("date").alias("day"),
        "series",
        "value",
        F.col("raw").isNotNull().alias("malformed"),
    )


@query(
    """SELECT lpad(asset_id, 4, '0') || '+%' AS asset_id, count(*) AS readings
       FROM readings GROUP BY 1"""
)
def asset_id_from_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names with a space, a plus and a percent sign."""
    stem = F.concat(F.lit("log of "), F.lpad("asset_id", 4, "0"), F.lit("+%"))
    path = write_reading_files(readings(spark, sf_dir), scratch(spark, "names"), stem)
    found = sources.read_readings(spark, path)
    return found.groupBy("asset_id").agg(F.count(F.lit(1)).alias("readings"))


@query(
    """SELECT asset_id, day, round(flighthours, 6) AS flighthours, flightcycles, delayedminutes
       FROM utilization"""
)
def scan_utilization_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored utilization table, read by the same function as a JDBC one."""
    path = scratch(spark, "utilization")
    roles.utilization_table(spark, sf_dir).write.parquet(path)
    table = sources.read_source(spark, {"format": "parquet", "path": path})
    return rounded(sources.utilization_from(table), ["flighthours"])


@query("SELECT asset_id, start_day FROM unscheduled")
def scan_interruptions_pushdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored interruptions table; both conditions are evaluated by its scan."""
    path = scratch(spark, "interruptions")
    roles.interruptions_table(spark, sf_dir).write.parquet(path)
    table = sources.read_source(spark, {"format": "parquet", "path": path})
    return sources.interruptions_from(table, roles.SUBSYSTEM, UNSCHEDULED_KINDS)


@query(f"SELECT {MEASURES_SQL}, maintenance FROM labelled")
def matrix_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "matrix-csv")
    sinks.write_matrix_csv(matrix(spark, sf_dir), path)
    return rounded(sources.read_matrix_csv(spark, path))


@query(
    f"""SELECT asset_id, day, {MEASURES_SQL}, maintenance, strftime(day, '%Y-%m') AS month
        FROM labelled"""
)
def matrix_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stored_matrix(spark, sf_dir)).withColumn("month", F.col("month").cast("string"))


@query(
    """SELECT lpad(asset_id, 6, '0') AS asset_id, day, round(average, 6) AS average,
              strftime(day, '%Y-%m') AS month FROM daily"""
)
def averages_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages of a directory that grows between two runs; the second run finds files
    of new assets and days, and late ones of days that were averaged before."""
    path, out, progress = (scratch(spark, name) for name in ("growing", "averages", "seen"))
    early = (F.dayofmonth("date") <= 20) & (F.col("series") == roles.SERIES[0])
    every = readings(spark, sf_dir)
    for new, prefix in ((early, "in-"), (~early, "late-")):
        stem = F.concat(F.lit(prefix), F.lpad("asset_id", 6, "0"))
        write_reading_files(every.filter(new), path, stem)
        update_averages(spark, path, out, progress).awaitTermination()
    return rounded(read_averages(spark, out))


@query("SELECT asset_id, day, requested_day FROM requests")
def parse_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests(spark, sf_dir)


@query(
    """SELECT asset_id, strftime(date, '%Y-%m-%d %H:%M:%S.%f') AS date, series, value
       FROM (SELECT * FROM readings UNION ALL
             SELECT CAST(user_id AS VARCHAR), ts, event_type, value FROM events
             WHERE event_type NOT IN ('view', 'click') UNION ALL
             SELECT * FROM readings)"""
)
def union_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicates are kept: one frame takes part twice."""
    some = readings(spark, sf_dir)
    others = roles.readings(spark, sf_dir, ["signup", "purchase", "error"])
    every = sources.union_readings([some, others, some])
    return every.withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


# Projections and filters.


@query(
    """SELECT asset_id, day, round(flighthours, 6) AS flighthours, flightcycles, delayedminutes
       FROM utilization"""
)
def project_utilization(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(utilization(spark, sf_dir), ["flighthours"])


@query(
    """SELECT event_id, CAST(ts AS DATE) AS day, strftime(ts, '%Y-%m-%d') AS day_text
       FROM events"""
)
def day_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.events(spark, sf_dir).select(
        "event_id",
        F.to_date("ts").alias("day"),
        F.date_format("ts", "yyyy-MM-dd").alias("day_text"),
    )


@query("SELECT asset_id, start_day FROM interruptions WHERE subsystem = 'error'")
def interruptions_by_subsystem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.interruptions_from(roles.interruptions_table(spark, sf_dir), roles.SUBSYSTEM)


@query("SELECT asset_id, start_day FROM unscheduled")
def interruptions_unscheduled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unscheduled(spark, sf_dir)


# Aggregates and joins.


@query("SELECT asset_id, day, round(average, 6) AS average FROM daily")
def daily_sensor_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(daily(spark, sf_dir))


@query(f"SELECT asset_id, day, {MEASURES_SQL} FROM base")
def join_readings_utilization(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = operators.join_on_keys(daily(spark, sf_dir), utilization(spark, sf_dir))
    return rounded(joined)


HUB_SQL = """
    SELECT CASE WHEN value > 40 THEN 'hub' ELSE CAST(user_id AS VARCHAR) END AS asset_id,
           CASE WHEN value > 40 THEN DATE '2024-01-15' ELSE CAST(ts AS DATE) END AS day,
           event_type, floor(value / 10) AS value, hour(ts) < 12 AS morning
    FROM events"""
HUB_DAILY_SQL = f"""
    SELECT asset_id, day, avg(value) AS average FROM ({HUB_SQL})
    WHERE event_type IN ('view', 'click') GROUP BY 1, 2"""
HUB_UTILIZATION_SQL = f"""
    SELECT asset_id, day, value AS flighthours, 1.0::DOUBLE AS flightcycles,
           value AS delayedminutes FROM ({HUB_SQL}) WHERE morning"""


def hub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events where one key holds a large part of all rows, many of them alike."""
    far = F.col("value") > 40
    return roles.events(spark, sf_dir).select(
        F.when(far, "hub").otherwise(roles.asset()).alias("asset_id"),
        F.when(far, F.lit("2024-01-15").cast("date")).otherwise(F.to_date("ts")).alias("day"),
        "event_type",
        F.floor(F.col("value") / 10).cast("double").alias("value"),
        (F.hour("ts") < roles.MORNING).alias("morning"),
    )


def hub_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = hub(spark, sf_dir).filter(F.col("event_type").isin(roles.SERIES))
    return operators.daily_average(seen.withColumnRenamed("day", "date"))


def hub_utilization(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hub(spark, sf_dir).filter("morning").select(
        *KEYS,
        F.col("value").alias("flighthours"),
        F.lit(1.0).alias("flightcycles"),
        F.col("value").alias("delayedminutes"),
    )


@query(
    f"""SELECT asset_id, day, round(average, 6) AS average, flighthours, flightcycles,
               delayedminutes
        FROM ({HUB_DAILY_SQL}) JOIN ({HUB_UTILIZATION_SQL}) USING (asset_id, day)"""
)
def join_hot_utilization(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Utilization that repeats keys, one of them very often."""
    repeated = hub_utilization(spark, sf_dir)
    hot = operators.hot_keys(repeated, rows_per_piece=100)
    return rounded(operators.join_on_keys(hub_daily(spark, sf_dir), repeated, "inner", hot))


def keyed(frame: DataFrame, name: str, **settings: int) -> operators.Keyed:
    """The frame by way of a table in buckets."""
    path = scratch(frame.sparkSession, name)
    sinks.write_keyed(frame, path, buckets=8, **settings)
    return sources.read_keyed(frame.sparkSession, path)


@query(
    f"""SELECT asset_id, day, round(average, 6) AS average, flighthours, flightcycles,
               delayedminutes
        FROM ({HUB_DAILY_SQL}) JOIN ({HUB_UTILIZATION_SQL}) USING (asset_id, day)"""
)
def join_stored_hot_utilization(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from tables in buckets, whose hot key is stored apart."""
    averages = keyed(hub_daily(spark, sf_dir), "hub-daily")
    repeated = keyed(hub_utilization(spark, sf_dir), "hub-utilization", rows_per_piece=100)
    return rounded(operators.join_keyed(averages.bucketed, repeated))


@query(
    f"""SELECT r.asset_id, r.day, requests, round(average, 6) AS average, flighthours,
               CASE WHEN average IS NULL THEN 'no_readings'
                    WHEN flighthours IS NULL THEN 'no_utilization' ELSE 'scored' END AS status
        FROM (SELECT asset_id, day, count(*) AS requests FROM ({HUB_SQL})
              WHERE event_type = 'purchase' GROUP BY 1, 2) r
        LEFT JOIN ({HUB_DAILY_SQL}) USING (asset_id, day)
        LEFT JOIN ({HUB_UTILIZATION_SQL}) USING (asset_id, day)"""
)
def request_features_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests where one key is asked for, and repeated in utilization, very often."""
    asked = sources.read_requests(
        hub(spark, sf_dir).filter(F.col("event_type") == "purchase"), "day", "asset_id"
    )
    repeated = hub_utilization(spark, sf_dir)
    known = operators.request_features(
        asked, hub_daily(spark, sf_dir), repeated, find_hot=True, rows_per_piece=100
    )
    return rounded(known).select(*KEYS, "requests", AVERAGE, "flighthours", "status")


@query(
    """SELECT asset_id, day, round(average, 6) AS average FROM daily
       WHERE (asset_id, day) IN (SELECT (asset_id, day) FROM requests WHERE day IS NOT NULL)"""
)
def readings_for_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = operators.take_requests(requests(spark, sf_dir))
    return rounded(operators.for_requests(daily(spark, sf_dir), asked))


@query(
    """SELECT asset_id, day, round(average, 6) AS average FROM daily
       WHERE (asset_id, day) IN (SELECT (asset_id, day) FROM requests WHERE day IS NOT NULL)"""
)
def readings_for_many_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As for more requests than are broadcast: their bits filter the readings."""
    asked = operators.take_requests(requests(spark, sf_dir), scratch(spark, "asked"))
    return rounded(operators.for_requests(daily(spark, sf_dir), asked, max_keys=0))


@query(
    f"""SELECT asset_id, day, {MEASURES_SQL} FROM base
        WHERE (asset_id, day) IN (SELECT (asset_id, day) FROM requests WHERE day IS NOT NULL)"""
)
def score_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        plans.score_features(
            requests(spark, sf_dir), daily(spark, sf_dir), utilization(spark, sf_dir)
        )
    )


# The label.


@query(
    """SELECT DISTINCT asset_id, start_day - CAST(i AS INTEGER) AS day
       FROM unscheduled, range(0, 8) AS days(i)"""
)
def interruption_days_expanded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.interruption_days(unscheduled(spark, sf_dir))


@query(f"SELECT asset_id, day, {MEASURES_SQL}, maintenance FROM labelled")
def label_horizon_documented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(matrix(spark, sf_dir))


@query(
    """SELECT asset_id, min(day) AS first, max(day) AS last FROM (
           SELECT asset_id, day, day - CAST(dense_rank() OVER (PARTITION BY asset_id ORDER BY day)
                                            AS INTEGER) AS island
           FROM (SELECT DISTINCT asset_id, start_day + 1 - CAST(i AS INTEGER) AS day
                 FROM unscheduled, range(0, 4) AS days(i)))
       GROUP BY asset_id, island"""
)
def interruption_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.interruption_spans(unscheduled(spark, sf_dir), 2, 1)


@query(
    f"""SELECT base.asset_id, base.day, {MEASURES_SQL}, CASE WHEN EXISTS (
                   SELECT 1 FROM unscheduled u WHERE u.asset_id = base.asset_id
                   AND base.day BETWEEN u.start_day - 365 AND u.start_day - 3)
               THEN 'unscheduled maintenance' ELSE 'no maintenance' END AS maintenance
        FROM base"""
)
def label_horizon_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Does an interruption follow in 3 to 365 days?"""
    return rounded(matrix(spark, sf_dir, before=365, after=-3))


@query(
    f"""SELECT asset_id, day, {MEASURES_SQL}, maintenance, strftime(day, '%Y-%m') AS month
        FROM labelled"""
)
def matrix_month_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A matrix stored unlabelled, of which each month is then written anew by itself."""
    path = scratch(spark, "months")
    full = matrix(spark, sf_dir)
    sinks.write_by_month(full.withColumn(LABEL, F.lit("not yet")), path)
    span = full.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    months = span.select(F.explode(F.sequence(F.trunc("a", "month"), "b", F.expr("interval 1 month"))).alias("m"))
    for row in months.select(F.date_format("m", "yyyy-MM").alias("m")).collect():
        sinks.write_by_month(plans.in_months(full, [row.m]), path, [row.m])
    return rounded(sources.read_matrix(spark, path)).withColumn("month", F.col("month").cast("string"))


@query(f"SELECT asset_id, day, {MEASURES_SQL}, maintenance FROM labelled")
def matrix_from_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix from stored averages and utilization, of which neither is shuffled."""
    return rounded(
        plans.build_stored_matrix(
            keyed(daily(spark, sf_dir), "daily-buckets"),
            keyed(utilization(spark, sf_dir), "utilization-buckets"),
            unscheduled(spark, sf_dir),
        )
    )


@query(f"SELECT asset_id, day, {MEASURES_SQL}, maintenance FROM labelled_as_coded")
def label_horizon_as_coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(matrix(spark, sf_dir, before=0, after=7, match="independent"))


@query(
    f"""SELECT asset_id, day, {MEASURES_SQL},
               CASE WHEN (asset_id, day) IN (SELECT (asset_id, start_day) FROM errors)
               THEN 'unscheduled maintenance' ELSE 'no maintenance' END AS maintenance,
               CASE WHEN day IN (SELECT start_day FROM errors)
                    AND asset_id IN (SELECT asset_id FROM errors)
               THEN 'unscheduled maintenance' ELSE 'no maintenance' END
               AS maintenance_independent
        FROM base"""
)
def label_same_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a horizon or a choice of kinds, paired and independent."""
    errors = sources.interruptions_from(roles.interruptions_table(spark, sf_dir), roles.SUBSYSTEM)
    averages = daily(spark, sf_dir)
    paired = operators.horizon_label(averages, errors, 0, 0)
    both = operators.horizon_label(
        paired.withColumnRenamed(LABEL, "paired"), errors, 0, 0, "independent"
    )
    joined = operators.join_on_keys(both, utilization(spark, sf_dir))
    return rounded(joined).select(
        *KEYS,
        *MEASURES,
        F.col("paired").alias(LABEL),
        F.col(LABEL).alias("maintenance_independent"),
    )


# Feature preparation and training.


@query(
    """SELECT asset_id, day, round(flighthours, 6) AS x0, round(flightcycles, 6) AS x1,
              round(delayedminutes, 6) AS x2, round(average, 6) AS x3, maintenance
       FROM labelled"""
)
def assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = learning.assembler().transform(matrix(spark, sf_dir))
    values = vector_to_array("features")
    return vectors.select(
        *KEYS,
        *[F.round(values[i], 6).alias(f"x{i}") for i in range(len(FEATURES))],
        LABEL,
    )


@query(
    """SELECT labelling, maintenance AS label, count(*) AS rows,
              CAST(row_number() OVER (PARTITION BY labelling
                   ORDER BY count(*) DESC, maintenance) - 1 AS DOUBLE) AS label_index
       FROM (SELECT 'documented' AS labelling, maintenance FROM labelled UNION ALL
             SELECT 'as coded', maintenance FROM labelled_as_coded)
       GROUP BY 1, 2"""
)
def label_index_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index by descending frequency: its meaning changes with the labelling."""
    labellings = {
        "documented": matrix(spark, sf_dir),
        "as coded": matrix(spark, sf_dir, before=0, after=7, match="independent"),
    }
    maps = [
        learning.label_index(labelled).withColumn("labelling", F.lit(name))
        for name, labelled in labellings.items()
    ]
    return reduce(DataFrame.unionByName, maps)


@query(
    """SELECT feature, value, row_number() OVER (PARTITION BY feature
                  ORDER BY value <> 0, value) - 1 AS category_index
       FROM (SELECT feature, value, count(*) OVER (PARTITION BY feature) AS categories
             FROM (SELECT 'quality' AS feature, CAST(quality AS DOUBLE) AS value FROM labels
                   UNION SELECT 'toxic', CAST(toxic AS DOUBLE) FROM labels
                   UNION SELECT 'doc_id', CAST(doc_id AS DOUBLE) FROM labels))
       WHERE categories <= 4"""
)
def feature_category_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = learning.category_map(roles.labels(spark, sf_dir), ["quality", "toxic", "doc_id"])
    return found.withColumn("category_index", F.col("category_index").cast("bigint"))


@query(
    """SELECT asset_id, day, bucket,
              CASE WHEN bucket < 70 THEN 'training' ELSE 'validation' END AS side
       FROM (SELECT asset_id, day, CAST(('0x' || substr(md5(asset_id || '|' || day), 1, 8))
                                        AS BIGINT) % 100 AS bucket FROM base)"""
)
def split_train_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.with_side(matrix(spark, sf_dir)).select(*KEYS, "bucket", "side")


@query(
    """SELECT asset_id, day, maintenance, label_index AS indexedLabel, prediction, verdict
       FROM foretold"""
)
def tree_train_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions for the validation rows by a tree fitted on the training rows."""
    trained = trained_stump(spark, sf_dir)
    predicted = learning.predict(trained.model, trained.validation)
    return predicted.select(*KEYS, LABEL, "indexedLabel", "prediction", "verdict")


@query(
    """SELECT asset_id, day, maintenance,
              CASE WHEN maintenance = 'no maintenance' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END
              AS label_index, TRUE AS verdict_fits
       FROM labelled
       WHERE CAST(('0x' || substr(md5(asset_id || '|' || day), 1, 8)) AS BIGINT) % 100 >= 70"""
)
def tree_predict_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every validation row is predicted once, under its key and label, and the
    verdict is the text of the predicted index."""
    _, validation = operators.split(matrix(spark, sf_dir))
    text = F.when(F.col("prediction") == 0, NEGATIVE).when(F.col("prediction") == 1, POSITIVE)
    return learning.predict(model(spark, sf_dir), validation).select(
        *KEYS,
        LABEL,
        F.col("indexedLabel").alias("label_index"),
        F.col("verdict").eqNullSafe(text).alias("verdict_fits"),
    )


@query(
    """SELECT metric, label, round(value, 6) AS value, rows FROM (
           SELECT 'accuracy' AS metric, CAST(NULL AS DOUBLE) AS label,
                  avg(CASE WHEN label_index = prediction THEN 1 ELSE 0 END) AS value,
                  count(*) AS rows FROM foretold
           UNION ALL
           SELECT 'test_error', NULL, avg(CASE WHEN label_index = prediction THEN 0 ELSE 1 END),
                  count(*) FROM foretold
           UNION ALL
           SELECT 'recall', label_index,
                  avg(CASE WHEN label_index = prediction THEN 1 ELSE 0 END), count(*)
           FROM foretold GROUP BY label_index)"""
)
def tree_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = planted(stored_matrix(spark, sf_dir))
    _, measured = plans.train_and_evaluate(given, max_categories=2, maxDepth=1)
    return rounded(measured, ["value"])


@query(
    f"""SELECT asset_id, day, {MEASURES_SQL}, indexedLabel, prediction FROM (
            SELECT *, label_index AS indexedLabel FROM foretold
            ORDER BY asset_id, day, flighthours, flightcycles, delayedminutes, average LIMIT 5)"""
)
def prediction_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five first predictions by key, a display feature."""
    _, validation = operators.split(planted(matrix(spark, sf_dir)))
    predicted = learning.predict(stump(spark, sf_dir), validation)
    shown = learning.preview(predicted)
    return rounded(shown).select(*KEYS, *FEATURES, "indexedLabel", "prediction")


@query(
    """SELECT feature, CASE WHEN feature = 'flightcycles' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
              AS importance, 1 AS depth, 3 AS nodes
       FROM (SELECT unnest(['flighthours', 'flightcycles', 'delayedminutes', 'average'])
             AS feature)"""
)
def tree_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learning.tree_summary(spark, stump(spark, sf_dir))


@query(
    """SELECT asset_id, day, TRUE AS same FROM base
       WHERE CAST(('0x' || substr(md5(asset_id || '|' || day), 1, 8)) AS BIGINT) % 100 >= 70"""
)
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The saved and reloaded model against the fitted one, row by row."""
    fitted = model(spark, sf_dir)
    path = scratch(spark, "model")
    sinks.write_model(fitted, path)
    _, validation = operators.split(matrix(spark, sf_dir))
    before = learning.predict(fitted, validation).select(
        *KEYS, *FEATURES, F.struct("probability", "verdict").alias("before")
    )
    after = learning.predict(sinks.read_model(path), before)
    same = F.col("before") == F.struct("probability", "verdict")
    return after.select(*KEYS, same.alias("same"))


# Evaluation, on two given columns.


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learning.confusion(roles.labels(spark, sf_dir), "quality", "toxic")


@query(
    """SELECT unnest(['accuracy', 'test_error']) AS metric,
              unnest([round(avg(hit), 6), round(1 - avg(hit), 6)]) AS value,
              count(*) AS rows
       FROM (SELECT CASE WHEN quality = toxic THEN 1 ELSE 0 END AS hit FROM labels)"""
)
def eval_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(learning.accuracy(predictions(spark, sf_dir)), ["value"])


@query(
    """SELECT CAST(quality AS DOUBLE) AS label,
              count(*) FILTER (WHERE toxic = quality) AS hits, count(*) AS rows,
              round(avg(CASE WHEN toxic = quality THEN 1 ELSE 0 END), 6) AS recall
       FROM labels GROUP BY 1"""
)
def eval_recall_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(learning.recall_by_label(predictions(spark, sf_dir)), ["recall"])


@query(
    """SELECT CAST(quality AS DOUBLE) AS label, CAST(toxic AS DOUBLE) AS prediction,
              count(*) AS rows FROM labels GROUP BY 1, 2"""
)
def eval_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions(spark, sf_dir)


# Scoring.


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.score(
        requests(spark, sf_dir),
        daily(spark, sf_dir),
        utilization(spark, sf_dir),
        stump(spark, sf_dir),
    )


@query("SELECT asset_id, day, requested_day, requests, status FROM status")
def request_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = operators.request_features(
        requests(spark, sf_dir), daily(spark, sf_dir), utilization(spark, sf_dir)
    )
    return known.select(*KEYS, "requested_day", "requests", "status")


@query(
    f"""SELECT asset_id, day, requested_day, requests, status, {MEASURES_SQL}, prediction,
               verdict FROM judged"""
)
def score_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scores(spark, sf_dir))


@query(
    f"""SELECT s.asset_id, s.day, requested_day, requests, status, {MEASURES_SQL},
               status = 'scored' AS has_verdict
        FROM status s LEFT JOIN daily USING (asset_id, day)
        LEFT JOIN utilization USING (asset_id, day)"""
)
def score_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request appears once with what is known of it; the complete ones,
    and only these, have a verdict."""
    both = F.col("prediction").isNotNull() & F.col("verdict").isNotNull()
    neither = F.col("prediction").isNull() & F.col("verdict").isNull()
    return (
        rounded(scores(spark, sf_dir))
        .withColumn("has_verdict", F.when(both, True).when(neither, False))
        .drop("prediction", "verdict")
    )


@query(
    """SELECT asset_id, coalesce(strftime(day, '%Y-%m-%d'), requested_day) AS day, requests,
              status, prediction, verdict FROM judged"""
)
def score_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.report(scores(spark, sf_dir))


@query("SELECT asset_id, requested_day, requests, status, prediction, verdict FROM judged")
def score_requests_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases arrive as a stream."""
    events = spark.readStream.schema(roles.EVENTS_SCHEMA).option(
        "pathGlobFilter", "events.parquet"
    ).parquet(sf_dir)
    averages = scratch(spark, "daily")
    daily(spark, sf_dir).write.parquet(averages)
    out = scratch(spark, "scores")
    running = score_stream(
        sources.read_requests(roles.requests_of(events)),
        lambda: spark.read.parquet(averages),
        lambda: utilization(spark, sf_dir),
        stump(spark, sf_dir),
        out,
        scratch(spark, "progress"),
    )
    running.awaitTermination()
    return read_scores(spark, out).select(
        "asset_id", "requested_day", "requests", "status", "prediction", "verdict"
    )
