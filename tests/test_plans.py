"""Physical-plan properties that matter at scale."""

import collections
import os
import re

import pytest

from shelfwise.operators.clean import dedup, impute
from shelfwise.operators.joins import join_validated
from shelfwise.operators.median import exact_median
from shelfwise.plans.catalog import Context
from shelfwise.plans.catalog import registry as queries
from shelfwise.plans.cells import store_cells
from shelfwise.plans.oil import city_months
from shelfwise.plans.traffic import traffic_daily
from shelfwise.session import size_shuffles

SF = "/root/testdata/sf0.001"
# Orders of windows over one row per month (or per lag or range partition).
MONTH_GRAIN = {"fecha_mes", "_month", "mes", "anio", "_bucket", "_pid", "lag_meses"}
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_python_in_the_plan(spark, name):
    p = plan(queries()[name](spark, SF))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p


def scans(df, table: str) -> list[str]:
    """Parquet scans of a stage table in the plan, its subqueries included."""
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "5000")
    return [line for line in plan(df).splitlines() if "FileScan parquet" in line and f"/shelfwise-stage/{table}-" in line]


def test_fact_scan_is_pruned(spark):
    (scan,) = scans(queries()["fd_violations"](spark, SF), "fact")
    assert "ReadSchema: struct<date:date,store_nbr:bigint,transactions:bigint>" in scan


@pytest.mark.parametrize("name, table, most", [
    ("headline", "fact", 0), ("promo_general", "fact", 0), ("sales_by_family", "fact", 0), ("sales_by_family", "family_cells", 0), ("ticket_class", "fact", 0),
    ("ticket_class", "store_traffic", 1), ("impute_median", "input_oil", 1), ("dq_checks", "fact", 1), ("oil_city_sensitivity", "store_cells", 0),
])
def test_tables_are_not_read_again(spark, name, table, most):
    """Of what a query's last job reads; a median or a share has read its table once before, into a table of its own."""
    assert len(scans(queries()[name](spark, SF), table)) <= most


def test_the_median_reads_its_rows_once(spark):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    values = spark.range(1000).selectExpr("id % 3 as k", "cast(id as double) as v").mapInArrow(count, "k long, v double")
    assert {r.k: r["median"] for r in exact_median(values, ["k"], "v").collect()} == {0: 499.5, 1: 499.0, 2: 500.0}
    assert read.value == 1000


def test_the_period_prunes_months(spark):
    (scan,) = scans(city_months(Context(spark, SF).store_cells), "store_cells")
    assert "PartitionFilters: [isnotnull(fecha_mes" in scan and "<= 1998-12-01" in scan


def test_a_validated_join_reads_and_shuffles_its_right_side_once(spark, tmp_path):
    for name in ("left", "right"):
        spark.range(500).selectExpr("id % 500 as k", "id as v").withColumnRenamed("v", f"v_{name}").write.parquet(str(tmp_path / name))
    left, right = (spark.read.parquet(str(tmp_path / name)) for name in ("left", "right"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(join_validated(left, right, ["k"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert p.count("FileScan parquet") == 2 and p.count("Exchange hashpartitioning") == 2 and "Broadcast" not in p


@pytest.mark.parametrize("name", sorted(queries()))
def test_windows_without_a_key_are_month_grain(spark, name):
    """Every window over days or finer is partitioned; unpartitioned ones order months (or a few totals)."""
    for line in plan(queries()[name](spark, SF)).splitlines():
        if "Window [" in line and "WindowGroupLimit" not in line:
            frames, keys = line.split("windowspecdefinition")[1:], re.findall(r"\], \[([^\]]*)(?=\])", line)
            assert frames and keys, line
            ordered = {re.sub(r"#\d+L?", "", k).split()[0] for k in keys[-1].split(",") if k.strip()}
            partitioned = len(keys) > 1 and keys[-2].strip() and "ASC" not in keys[-2] and "DESC" not in keys[-2]
            assert partitioned or ordered <= MONTH_GRAIN, line


def test_sales_rows_are_shuffled_once_for_cells_and_days(spark):
    """The store cells are dealt once for sums and month folders, and a store's days once for both steps of their totals."""
    c = Context(spark, SF)
    assert plan(store_cells(c.fact, 10**9)).count("Exchange hashpartitioning") == 1
    assert plan(traffic_daily(c.store_cells)).count("Exchange hashpartitioning") == 1
    assert not any("fecha_mes=" in file for file in c.fact.inputFiles())  # the wide rows are not dealt by month
    files = collections.Counter(file.rsplit("/", 2)[1] for file in c.store_cells.inputFiles())
    assert max(files.values()) == 1


def test_cells_are_the_same_however_a_month_is_spread(spark, monkeypatch):
    monkeypatch.setattr("shelfwise.plans.cells.SPREAD_ROWS", 7)
    fact = Context(spark, SF).fact
    one, many = (sorted(map(str, store_cells(fact, rows).collect())) for rows in (0, 100))
    assert one == many and len(one) > 100


def test_the_join_that_shuffles_the_sales_rows_comes_first(spark):
    p = plan(Context(spark, SF).consolidated.fact)
    joins = [line for line in p.splitlines() if "Join" in line and "store_nbr" in line]  # the last one printed runs first
    assert len(joins) == 2 and "date" in joins[1] and "date" not in joins[0].split("LeftOuter")[0]


def test_distinct_rows_are_derived_once_where_nulls_are_filled(spark):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.range(100).selectExpr("id % 50 as k", "if(id % 50 < 5, null, cast(id % 50 as double)) as v").mapInArrow(count, "k long, v double")
    clean, log = impute(dedup(rows), "t", before=rows)
    assert sorted(r.v for r in clean.collect())[22:28] == [27.0] * 6 and [(r.column, r.cantidad) for r in log.collect()] == [("v", 5)]
    assert read.value == 200  # the nulls of all rows, and the distinct rows


def test_shuffles_start_with_partitions_for_their_input(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    was = spark.conf.get(name, None)
    try:
        size_shuffles(spark, 4 << 30)
        assert spark.conf.get(name) == "1024"
        size_shuffles(spark, 1 << 20)  # never lowered
        assert spark.conf.get(name) == "1024"
    finally:
        spark.conf.set(name, was) if was else spark.conf.unset(name)
