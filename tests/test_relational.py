"""Known answers and plan shapes of the relational operators."""

import pytest
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from pyspark.storagelevel import StorageLevel

import fixtures as fx
from conftest import plan, rows
from millpond.functions.scalars import band, lookup, lookup_udf, parse_amount, parse_date, parse_timestamp
from millpond.operators.dedup import duplicate_keys, first_per_key, last_per_key
from millpond.operators.groups import top_per_group, with_group_stats
from millpond.operators.joins import broadcast_checked
from millpond.operators.layout import file_count_for
from millpond.operators.quality import count_where, layer_counts, split_valid

SF = "/root/testdata/sf0.001"


@pytest.fixture
def employees(spark):
    return spark.createDataFrame(fx.EMPLOYEES, fx.EMPLOYEES_SCHEMA)


@pytest.fixture
def departments(spark):
    return spark.createDataFrame(fx.DEPARTMENTS, "dept_id int, dept_name string")


@pytest.fixture
def projects(spark):
    return spark.createDataFrame(fx.PROJECTS, "project_id int, dept_name string")


def test_department_summary(employees):
    summary = employees.groupBy("dept").agg(
        F.count("*").alias("n"), F.round(F.avg("salary"), 2).alias("avg"), F.sum("salary").alias("sum")
    )
    assert rows(summary, "dept") == [
        ("Engineering", 5, 99800.0, 499000), ("HR", 2, 63000.0, 126000), ("Marketing", 3, 71666.67, 215000),
    ]
    assert rows(summary.filter("avg > 80000").select("dept")) == [("Engineering",)]


def test_city_count(employees):
    assert rows(employees.groupBy("city").count(), "city") == [("Berlin", 3), ("London", 3), ("New York", 4)]


def test_top_per_group_keeps_ties(employees):
    best = top_per_group(employees, ["dept"], "salary").select("dept", "name")
    assert rows(best, "dept") == [("Engineering", "Grace"), ("HR", "Frank"), ("Marketing", "Ivy")]
    tied = employees.union(employees.where("name = 'Grace'").withColumn("name", F.lit("Gus")))
    assert rows(top_per_group(tied, ["dept"], "salary").where("dept = 'Engineering'").select("name")) == [
        ("Grace",), ("Gus",)
    ]


def test_above_group_average(employees):
    rated = with_group_stats(employees, ["dept"], F.round(F.avg("salary"), 2).alias("dept_avg"))
    above = rated.filter(F.col("salary") > F.col("dept_avg"))
    assert [r[0] for r in rows(above.select("name"), "name")] == ["Bob", "Carol", "Frank", "Grace", "Ivy"]
    assert rated.columns == [*employees.columns, "dept_avg"]
    assert rated.count() == 10


def test_group_stats_of_null_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), ("a", 5)], "g string, x int")
    rated = with_group_stats(df, ["g"], F.avg("x").alias("m"))
    assert rows(rated, "x") == [(None, 1, 2.0), (None, 3, 2.0), ("a", 5, 5.0)]


def test_bands(employees):
    banded = employees.select("name", band(F.col("salary"), [(100000, "Senior"), (80000, "Mid")], "Junior").alias("b"))
    by = {b: sorted(r.name for r in banded.collect() if r.b == b) for b in ("Senior", "Mid", "Junior")}
    assert by["Senior"] == ["Carol", "Grace"]
    assert by["Mid"] == ["Alice", "Eve", "Jack"]
    assert len(by["Junior"]) == 5


def test_join_sizes(employees, departments, projects):
    match = F.col("dept") == F.col("dept_name")
    assert employees.join(departments, match, "inner").count() == 10
    assert employees.join(departments, match, "right").count() == 11
    assert departments.join(employees, match, "left").count() == 11
    d, p = departments.alias("d"), projects.alias("p")
    same = F.col("d.dept_name") == F.col("p.dept_name")
    assert d.join(p, same, "full").count() == 6
    assert rows(d.join(p, same, "left_anti").select("dept_name")) == [("Finance",)]
    assert rows(p.join(d, same, "left_anti").select("project_id")) == [(105,)]
    # the plain cross product stays a DataFrame method
    assert employees.crossJoin(departments).count() == 40


def test_same_name_on_both_sides_is_ambiguous(departments, projects):
    with pytest.raises(AnalysisException, match="AMBIGUOUS"):
        departments.join(projects, F.col("dept_name") == F.col("dept_name")).collect()


def test_broadcast_is_checked(employees, departments):
    match = F.col("dept") == F.col("dept_name")
    assert "BroadcastHashJoin" in plan(employees.join(broadcast_checked(departments), match))
    too_large = broadcast_checked(departments, max_bytes=80)
    assert too_large is departments
    nested = departments.select(F.array("dept_name").alias("names"), F.struct("dept_id").alias("s"))
    assert broadcast_checked(nested, max_bytes=10) is nested and broadcast_checked(nested) is not nested


def test_sort_merge_join_plan(spark):
    from millpond.queries import QUERIES

    text = plan(QUERIES["sort_merge_join"](spark, SF))
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_filters_and_columns_reach_the_scan(spark):
    from millpond.queries import QUERIES

    text = plan(QUERIES["scan_parquet"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_shipdate), IsNotNull(l_returnflag), GreaterThanOrEqual(l_shipdate" in text
    assert "l_tax" not in text
    text = plan(QUERIES["filter_group_sort"](spark, SF))
    assert "GreaterThan(o_totalprice,80000.0)" in text and "o_custkey" not in text


def test_no_window_or_python_in_group_comparisons(spark):
    from millpond.queries import QUERIES

    for name in ("above_group_avg", "top_per_group", "dedup_by_key", "map_lookup"):
        text = plan(QUERIES[name](spark, SF))
        assert "Window" not in text and "Python" not in text, name
    assert "BatchEvalPython" not in plan(QUERIES["map_lookup_udf"](spark, SF))


def test_point_in_time_join_hashes_on_the_key(spark):
    from millpond.queries import QUERIES

    text = plan(QUERIES["scd2_point_in_time"](spark, SF))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_no_query_uses_a_product(spark):
    from millpond.queries import QUERIES

    for name in ("cross_join", "layer_counts", "full_outer_join", "range_select"):
        text = plan(QUERIES[name](spark, SF))
        assert "NestedLoop" not in text and "Cartesian" not in text, name


def test_first_and_last_per_key(spark):
    df = spark.createDataFrame(
        [(1, "b", 2, None), (1, "a", 1, "x"), (1, "c", 3, "y"), (2, "z", 1, None), (None, "n", 1, "q")],
        "k int, v string, at int, w string",
    )
    assert rows(first_per_key(df, ["k"], ["at"]), "k") == [(None, "n", 1, "q"), (1, "a", 1, "x"), (2, "z", 1, None)]
    assert rows(last_per_key(df, ["k"], ["at"]), "k") == [(None, "n", 1, "q"), (1, "c", 3, "y"), (2, "z", 1, None)]
    assert first_per_key(df, ["k"], ["at"]).columns == df.columns
    assert first_per_key(df.select("k"), ["k"], []).count() == 3


def test_dedup_combines_before_the_shuffle(spark):
    text = plan(first_per_key(spark.range(10).selectExpr("id % 2 AS k", "id"), ["k"], ["id"]))
    assert text.count("partial_min") >= 1


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "a int, b int")
    assert rows(duplicate_keys(df, ["a", "b"])) == [(1, 1, 2)]


def test_split_loses_nothing(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (None, 3.0), (4, -1.0)], "id int, amount double")
    ok, bad = split_valid(df, F.col("id").isNotNull() & (F.col("amount") > 0))
    assert rows(ok) == [(1, 5.0)]
    assert ok.count() + bad.count() == df.count()


def test_counters(spark):
    df = spark.createDataFrame([(1,), (-5,), (None,), (9000,)], "amount int")
    counted = count_where(df, negative=F.col("amount") < 0, high=F.col("amount") > 8000)
    assert rows(counted) == [(1, 1)]
    assert rows(layer_counts({"all": df, "known": df.where("amount IS NOT NULL")}), "layer") == [
        ("all", 4), ("known", 3)
    ]


def test_lookup_forms_agree(spark, employees):
    divisions = {"Engineering": "Technology", "Marketing": "Commercial"}
    shared = spark.sparkContext.broadcast(divisions)
    both = employees.select(
        "dept", lookup(F.col("dept"), divisions, "Unknown").alias("native"),
        lookup_udf(shared, "Unknown")("dept").alias("python"),
    ).distinct()
    found = rows(both, "dept")
    assert found == [
        ("Engineering", "Technology", "Technology"), ("HR", "Unknown", "Unknown"),
        ("Marketing", "Commercial", "Commercial"),
    ]
    shared.destroy()


def test_untrusted_text(spark):
    df = spark.createDataFrame([("12,500.00", "15/03/2019"), ("N/A", "2019-03-15"), (None, None)], "a string, d string")
    parsed = df.select(parse_amount(F.col("a")), parse_date(F.col("d"), "dd/MM/yyyy").cast("string"))
    assert rows(parsed) == [(12500.0, "2019-03-15"), (None, None), (None, None)]
    stamps = spark.createDataFrame([("2024-01-15T08:00:00",), ("soon",)], "t string")
    assert [str(r[0]) for r in stamps.select(parse_timestamp(F.col("t"))).collect()] == ["2024-01-15 08:00:00", "None"]


def test_partition_counts(spark, employees):
    assert employees.repartition(8).rdd.getNumPartitions() == 8
    assert employees.repartition(8).coalesce(2).rdd.getNumPartitions() == 2
    assert employees.repartition(4, "dept").rdd.getNumPartitions() == 4
    assert "Exchange" in plan(employees.repartition(8)) and "Exchange" not in plan(employees.coalesce(2))


@pytest.mark.parametrize("level", [StorageLevel.MEMORY_AND_DISK, StorageLevel.MEMORY_ONLY, StorageLevel.DISK_ONLY])
def test_storage_levels(employees, level):
    kept = employees.where("salary > 0").persist(level)
    assert kept.is_cached and kept.count() == 10
    assert not kept.unpersist().is_cached


def test_file_count_rule():
    assert file_count_for(2 * 1024**3) == 16
    assert file_count_for(1) == 1


def test_session_functions(spark):
    row = spark.sql("SELECT 1 AS one, current_user() AS who, current_timestamp() AS now").first()
    assert row.one == 1 and row.who and row.now
    assert spark.createDataFrame([(1, 2.5, "x")], ["a", "b", "c"]).dtypes == [
        ("a", "bigint"), ("b", "double"), ("c", "string")
    ]
