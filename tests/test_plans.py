"""What the physical plans must and must not contain."""

import pathlib
import re

import pytest

from testbed import catalog
from tests.conftest import DATA, ROOT
from upkeep import learning, operators, sources
from upkeep.fixed import FEATURES, LABEL
from upkeep.learning.tree import laid_out, planned_partitions

SF = f"{DATA}/sf0.001"
RELATIONAL = [
    "daily_sensor_average",
    "join_readings_utilization",
    "join_hot_utilization",
    "interruption_days_expanded",
    "label_horizon_documented",
    "label_horizon_as_coded",
    "label_same_day",
    "split_train_validation",
    "readings_for_requests",
    "score_features",
    "request_status",
    "request_features_hot",
    "eval_confusion",
]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(params=["broadcast", "shuffle"])
def joins(spark, request):
    """Plans as for small tables, and as for tables too large to broadcast."""
    if request.param == "shuffle":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_join_by_comparing_all_pairs(spark, joins, name):
    plan = plan_of(catalog.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan


def test_relational_work_stays_out_of_python(spark):
    for name in RELATIONAL:
        plan = plan_of(catalog.QUERIES[name](spark, SF))
        assert not re.search(r"Python|Pandas|DeserializeToObject", plan), name


def test_averages_are_partial_before_the_shuffle(spark):
    plan = plan_of(catalog.daily(spark, SF))
    assert plan.count("Exchange") == 1
    below = plan[plan.index("Exchange") :]
    assert "partial_avg" in below


def test_matrix_shuffles_each_input_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(catalog.matrix(spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Averages, interruption days, utilization; the joins reuse their partitioning.
    assert plan.count("Exchange hashpartitioning") == 3
    assert plan.count("SortMergeJoin") == 2


def test_few_requests_drop_readings_before_they_are_averaged(spark):
    asked = operators.take_requests(catalog.requests(spark, SF))
    plan = plan_of(operators.for_requests(catalog.daily(spark, SF), asked))
    assert plan.index("partial_avg") < plan.index("LeftSemi")


def test_many_requests_join_averages_not_readings(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        held = catalog.scratch(spark, "held")
        asked = operators.take_requests(catalog.requests(spark, SF), held)
        plan = plan_of(operators.for_requests(catalog.daily(spark, SF), asked, max_keys=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The keys join the averages, and their bits the readings, before these are summed.
    above, below = plan.split("partial_avg")
    assert "SortMergeJoin" in above and above.count("LeftSemi") == 1
    assert below.index("BroadcastHashJoin") < below.index("LeftSemi") < below.index("FileScan")
    # The averages; then words and blocks of the bits, and the requested keys.
    assert above.count("Exchange hashpartitioning") == 1
    assert below.count("Exchange hashpartitioning") == 3


def test_range_of_requested_days_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "utilization")
    catalog.roles.utilization_table(spark, SF).write.parquet(path)
    asked = operators.take_requests(catalog.requests(spark, SF))
    kpis = sources.utilization_from(spark.read.parquet(path))
    plan = plan_of(operators.for_requests(kpis, asked, max_keys=0))
    assert f"GreaterThanOrEqual(timeid,{asked.first})" in plan
    assert f"LessThanOrEqual(timeid,{asked.last})" in plan


def test_sensor_files_are_read_without_the_series(spark, tmp_path):
    (tmp_path / "AB1234.csv").write_text("date;series;value\n2024-01-01 10:00:00;s;1\n")
    plan = plan_of(operators.daily_average(sources.read_readings(spark, str(tmp_path))))
    assert "ReadSchema: struct<date:timestamp,value:double>" in plan


def test_library_gathers_nothing_unbounded():
    """Driver-side gathering is limited to the four places whose size is bounded."""
    found = {}
    for path in sorted(pathlib.Path(ROOT, "upkeep").rglob("*.py")):
        if "llm" in path.parts:  # has tests of its own
            continue
        text = path.read_text()
        assert not re.search(r"localCheckpoint|crossJoin|toPandas|\.rdd\b|toLocalIterator", text)
        count = len(re.findall(r"\.(?:collect|first|take|head)\(", text))
        if count:
            found[path.name] = count
    assert found == {"hotkeys.py": 1, "requests.py": 1, "keyed.py": 1, "tables.py": 1}


def test_status_reads_requests_once_and_each_table_once(spark):
    path = operators.take_requests(catalog.requests(spark, SF), catalog.scratch(spark, "held"))
    known = operators.request_features(path, catalog.daily(spark, SF), catalog.utilization(spark, SF))
    # Twice events (readings, utilization) and the snapshot: keys, valid and invalid rows.
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")  # else long paths are cut
    try:
        plan = plan_of(known)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert plan.count("/held-") == 4 and plan.count("events.parquet") == 2


def test_a_hot_request_is_dealt(spark):
    plan = plan_of(catalog.request_features_hot(spark, f"{DATA}/sf0.01"))
    assert "_piece" in plan and "_pieces" in plan


def test_one_shuffle_before_the_tree_is_fitted(spark):
    matrix = spark.read.parquet(write(spark))
    plan = plan_of(laid_out(matrix, [*FEATURES, LABEL], 4))
    assert plan.count("Exchange") == 1


def test_the_number_of_training_partitions_costs_no_column(spark):
    matrix = spark.read.parquet(write(spark))
    assert planned_partitions(matrix, 70) == 1
    plan = plan_of(matrix.groupBy().count())
    assert "ReadSchema: struct<>" in plan


def write(spark):
    path = catalog.scratch(spark, "matrix")
    catalog.matrix(spark, SF).write.parquet(path)
    return path


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_the_tree_does_not_depend_on_the_input_partitions(spark, partitions):
    matrix = spark.read.parquet(write(spark)).repartition(partitions)
    trained = learning.train(matrix, partitions=3)
    expected = learning.train(matrix.coalesce(1), partitions=3)
    trees = [t.model.stages[3].toDebugString.partition("\n")[2] for t in (trained, expected)]
    assert trees[0] == trees[1]


def test_split_reads_no_more_than_the_matrix(spark):
    plans = [plan_of(f(spark, SF)).count("FileScan") for f in (catalog.split_train_validation, catalog.matrix)]
    assert plans[0] <= plans[1]  # the label is not even joined


def test_label_index_reads_the_matrix_once(spark):
    plan = plan_of(learning.label_index(catalog.matrix(spark, SF)))
    assert plan.count("FileScan") == 3
