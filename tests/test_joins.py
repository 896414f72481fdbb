import random

import pytest
from pyspark.sql import functions as F

from tests.frames import daily, keys, rows, utilization
from upkeep.operators import hotkeys, keyfilter, hot_keys, join_on_keys, pack_copies, spread, unpack_copies


@pytest.fixture(scope="module")
def inputs(spark):
    """Averages with unique keys, utilization where one key has most rows."""
    draw = random.Random(5)
    days = [f"2024-01-{n:02d}" for n in range(1, 21)]
    averages = [(a, d, draw.random()) for a in "abcd" for d in days]
    alike = [("a", "2024-01-03", 1, 2, 3)] * 250
    different = [("a", "2024-01-03", n, 2, 3) for n in range(150)]
    others = [(a, d, draw.randint(0, 9), 1, 1) for a in "abcde" for d in days[:15]]
    nulls = [(None, "2024-01-03", 1, 1, 1), ("a", None, 1, 1, 1)]
    unmatched = [("zz", "2024-01-03", n % 3, 1, 1) for n in range(120)]
    return (
        daily(spark, averages).coalesce(2),
        utilization(spark, [*alike, *different, *others, *nulls, *unmatched]).coalesce(2),
    )


def test_hot_keys_are_few_and_know_their_pieces(inputs):
    _, many = inputs
    found = hot_keys(many, rows_per_piece=30)
    assert {(r["asset_id"], r["_pieces"]) for r in found.collect()} == {("a", 14), ("zz", 4)}
    assert hot_keys(many) is None
    assert hot_keys(many.limit(0), rows_per_piece=1) is None


def test_the_limit_does_not_grow_with_the_data(spark):
    """A key below a thousandth of the rows is split if it is above the limit."""
    rows = spark.range(200_000).selectExpr(
        "if(id < 150, 'hot', cast(id as string)) AS asset_id", "DATE '2024-01-01' AS day"
    )
    found = hot_keys(rows, rows_per_piece=100).collect()
    assert [(r["asset_id"], r["_pieces"]) for r in found] == [("hot", 2)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_very_many_hot_keys_stay_a_plan(inputs, how, monkeypatch):
    few, many = inputs
    monkeypatch.setattr(hotkeys, "LITERAL_KEYS", 1)
    hot = hot_keys(many, rows_per_piece=30)
    assert "LocalTableScan" not in hot._jdf.queryExecution().executedPlan().toString()
    plain = join_on_keys(few, many, how)
    assert rows(join_on_keys(few, many, how, hot).select(*plain.columns)) == rows(plain)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("chunk", [7, 10_000])
def test_dealt_out_join_gives_the_plain_rows(inputs, how, chunk):
    few, many = inputs
    hot = hot_keys(many, rows_per_piece=20)
    assert hot.count() == 2
    plain = join_on_keys(few, many, how)
    dealt = join_on_keys(few, many, how, hot, chunk=chunk)
    assert sorted(dealt.columns) == sorted(plain.columns)
    assert rows(dealt.select(*plain.columns)) == rows(plain)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_that_are_gone(inputs, how):
    few, many = inputs
    hot = hot_keys(many, rows_per_piece=20)
    left_over = many.filter("NOT (asset_id = 'a' AND day = '2024-01-03')")
    plain = join_on_keys(few, left_over, how)
    assert rows(join_on_keys(few, left_over, how, hot).select(*plain.columns)) == rows(plain)


def test_hot_rows_go_to_many_partitions(spark, inputs):
    few, many = inputs
    hot = hot_keys(many, rows_per_piece=20)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        def largest(hot):
            joined = join_on_keys(few, many, "inner", hot, chunk=7)
            part = joined.filter("asset_id = 'a' AND day = '2024-01-03'").groupBy(
                F.spark_partition_id()
            )
            return max(r["count"] for r in part.count().collect())

        assert largest(None) == 401
        assert largest(hot) < 200
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_unknown_join_type(inputs):
    with pytest.raises(ValueError):
        join_on_keys(*inputs, how="outer")


def test_packing_keeps_every_copy(spark):
    frame = spark.createDataFrame(
        [("a", 1.0)] * 25 + [("b", None)] * 3 + [(None, None)], "x string, y double"
    )
    packed = pack_copies(frame, 10)
    assert sorted(r["_copies"] for r in packed.collect()) == [1, 3, 5, 10, 10]
    assert unpack_copies(packed).columns == ["x", "y"]
    assert rows(unpack_copies(packed)) == rows(frame)


def test_spread_depends_on_content_alone_and_divides_copies(spark):
    frame = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.col("id").cast("double")).alias("x")
    )

    def layout(given):
        placed = spread(given, 8, chunk=50).withColumn("p", F.spark_partition_id()).collect()
        return [(r["p"], r["x"]) for r in placed]

    first = layout(frame.repartition(3))
    assert first == layout(frame.repartition(13, "x"))
    assert sorted(x for _, x in first) == sorted(r["x"] for r in frame.collect())
    sizes = [sum(1 for p, _ in first if p == n) for n in range(8)]
    assert max(sizes) < 2 * 4000 / 8


# Keys as bits.


def test_bits_are_bounded():
    sizes = [keyfilter.filter_bits(n) for n in (0, 1, 10**6, 10**12)]
    assert sizes == [64 * keyfilter.WORDS, 64 * keyfilter.WORDS, 1 << 24, keyfilter.MOST_BITS]


@pytest.mark.parametrize("bits", [64 * keyfilter.WORDS, 1 << 17])
def test_bits_lose_no_key(spark, bits):
    """Every asked row stays; of the others about as many as bits are set."""
    asked = spark.range(3000).selectExpr("concat('a', id) asset_id", "date '2024-01-01' day")
    every = spark.range(60_000).selectExpr("concat('a', id) asset_id", "date '2024-01-01' day", "id")
    stored = keyfilter.key_filter(asked, bits)
    assert stored.count() <= bits // 64 // keyfilter.WORDS
    assert {len(r["_words"]) for r in stored.collect()} == {keyfilter.WORDS}
    kept = keyfilter.maybe_in(every, asked, bits)
    assert kept.columns == every.columns
    others = kept.filter("id >= 3000").count()
    assert kept.filter("id < 3000").count() == 3000
    share = 1 - (1 - 1 / bits) ** 3000
    assert abs(others / 57_000 - share) < 0.01


def test_bits_of_no_keys_and_of_nulls(spark):
    nothing = keys(spark, [])
    some = keys(spark, [("a", "2024-01-01"), (None, "2024-01-01")])
    assert keyfilter.maybe_in(some, nothing, 1 << 14).count() == 0
    assert rows(keyfilter.maybe_in(some, some, 1 << 14)) == rows(some)
