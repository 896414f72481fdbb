import hashlib

from pyspark.sql import functions as F

from tests.frames import day
from upkeep.functions import asset_id_from_file, key_bucket, month_of, parse_day
from upkeep.operators import random_split, split


def test_asset_id_is_a_slice_of_the_file_name(spark):
    # Metadata percent-encodes names; a plus sign stays as it is.
    names = {
        "flight-AB1234.csv": "AB1234",
        "123456.csv": "123456",
        "zz.csv": "zz",
        "a.csv": "a",
        ".csv": "",
        "a+b.csv": "a+b",
        "log%20of%2017+%25.csv": " 17+%",
        "x%C3%9F12345.csv": "ß12345",
    }
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    got = frame.select("name", asset_id_from_file(F.col("name")).alias("id")).collect()
    expected = dict(names)
    expected["log%20of%2017+%25.csv"] = "log of 17+%.csv"[-10:-4]
    assert {row["name"]: row["id"] for row in got} == expected


def test_parse_day_takes_only_well_formed_days(spark):
    texts = {
        "2024-01-05": "2024-01-05",
        "2024-1-5": "2024-01-05",
        "2024-02-29": "2024-02-29",
        "2023-02-29": None,
        "2024-13-01": None,
        "2024-01": None,
        "2024": None,
        "2024-01-05 10:00": None,
        "2024-01-05T10:00:00": None,
        " 2024-01-05": None,
        "2024-01-05\n": None,
        "24-01-05": None,
        "0000-01-05": None,
        "12024-01-05": None,
        "exit": None,
        "": None,
    }
    frame = spark.createDataFrame([*[(t,) for t in texts], (None,)], "text string")
    parsed = frame.select("text", parse_day(F.col("text")).alias("d"))
    got = {r["text"]: r["d"] for r in parsed.collect()}
    assert got == {**{t: day(d) for t, d in texts.items()}, None: None}


def test_key_bucket_is_the_md5_of_the_key(spark):
    frame = spark.createDataFrame(
        [("7", day("2024-01-05")), ("ä|b", day("1999-12-31"))], "asset_id string, day date"
    )
    for row in frame.withColumn("bucket", key_bucket()).collect():
        text = f"{row['asset_id']}|{row['day']}".encode()
        assert row["bucket"] == int(hashlib.md5(text).hexdigest()[:8], 16) % 100


def test_month_of(spark):
    frame = spark.createDataFrame([(day("2024-02-29"),)], "d date")
    assert frame.select(month_of(F.col("d"))).first()[0] == "2024-02"


def test_each_row_is_on_one_side_and_keys_stay_together(spark):
    frame = spark.range(5000).select(
        F.col("id"),
        (F.col("id") % 1500).cast("string").alias("asset_id"),
        F.lit("2024-01-05").cast("date").alias("day"),
    )
    training, validation = split(frame, 70)
    left, right = training.collect(), validation.collect()
    assert len(left) + len(right) == 5000
    assert not {r["id"] for r in left} & {r["id"] for r in right}
    assert not {r["asset_id"] for r in left} & {r["asset_id"] for r in right}
    assert 0.65 < len(left) / 5000 < 0.75

    drawn = [side.count() for side in random_split(frame, 70, seed=3)]
    assert sum(drawn) == 5000
    assert drawn == [side.count() for side in random_split(frame, 70, seed=3)]
