"""The clean stage runs before the consolidation, from whichever source."""

import os

import pytest
from pyspark.sql import functions as F

from shelfwise.plans.catalog import Context, cleaning_metrics
from shelfwise.plans.consolidate import Consolidated, consolidate, consolidation_metrics
from shelfwise.sources.contract import FILES, load_sources
from shelfwise.sources.sinks import stage_path

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).withColumns({c: F.round(c, 6) for c, t in df.dtypes if t == "double"}).collect()))


def test_doubled_inputs_give_the_same_fact(spark):
    plain = Context(spark, SF)
    doubled = {name: df.unionByName(df) if name != "oil" else df for name, df in plain.raw_inputs.items()}
    doubled["stores"] = plain.raw_inputs["stores"].withColumn("city", F.when(F.col("store_nbr") == 1, None).otherwise(F.col("city"))).unionByName(
        plain.raw_inputs["stores"].withColumn("city", F.when(F.col("store_nbr") == 1, None).otherwise(F.col("city"))))
    fact = Context(spark, SF, doubled).fact
    assert fact.count() == plain.fact.count()
    assert fact.where("city is null").count() == 0
    assert rows(fact.drop("city")) == rows(plain.fact.drop("city"))


def test_csv_files_give_the_same_fact(spark, tmp_path):
    plain = Context(spark, SF)
    for name, file in FILES.items():
        frame = plain.raw_inputs[name].coalesce(1)
        frame = frame.withColumn("id", F.monotonically_increasing_id()) if name == "train" else frame
        frame.write.option("header", True).csv(f"{tmp_path}/{file}")
    fact = Context(spark, str(tmp_path), load_sources(spark, str(tmp_path))).fact
    assert fact.columns[0] == "id"
    assert rows(fact.drop("id")) == rows(plain.fact)


def test_a_missing_file_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="required file"):
        load_sources(spark, str(tmp_path))


def test_consolidation_without_validation_multiplies_rows(spark):
    """J11: the unvalidated variant keeps every match; the validated one stops."""
    i = Context(spark, SF).inputs
    twice = i["transactions"].unionByName(i["transactions"].limit(1))
    made = lambda **k: consolidate(i["train"], i["stores"], twice, i["oil"], i["holidays_events"], **k).fact
    key = i["transactions"].limit(1)
    extra = i["train"].join(key, ["store_nbr", "date"]).count()
    assert extra > 0 and made(validate=False).count() == i["train"].count() + extra
    with pytest.raises(Exception, match="not unique on the right"):
        made().write.format("noop").mode("overwrite").save()


def test_rows_lost_or_added_stop_the_fact(spark, monkeypatch):
    """E3: the rows written are compared with the sales rows."""
    c = Context(spark, SF, {name: df for name, df in Context(spark, SF).raw_inputs.items()})
    _ = c.inputs
    monkeypatch.setattr(c, "counts", lambda name: {"rows": 7, "nulls": 0})
    c.__dict__["key"] = "rows-lost"
    with pytest.raises(ValueError, match="rows of 7 sales rows"):
        _ = c.fact


def test_metrics_have_the_size_of_what_was_written(spark):
    c = Context(spark, SF)
    path = stage_path(spark, "fact", c.key) if c.fact is not None else ""
    row = consolidation_metrics(c.inputs["train"], Consolidated(c.fact, c.consolidated.holidays, c.consolidated.price), path).first()
    assert row.bytes_consolidado > 10_000 and row.filas_train == row.filas_consolidado
    assert 0 < row.filas_transacciones_ausentes <= row.filas_sin_transacciones


def test_nulls_after_cleaning_are_those_written(spark):
    plain = Context(spark, SF)
    sources = dict(plain.raw_inputs)
    sources["stores"] = sources["stores"].withColumn("city", F.when(F.col("store_nbr") == 1, None).otherwise(F.col("city"))).withColumn("state", F.lit(None).cast("string"))
    c = Context(spark, SF, sources)
    c.__dict__["key"] = "stores-with-nulls"
    n = sources["stores"].count()
    row = {r.dataset: r for r in cleaning_metrics(c).collect()}["stores"]
    assert (row.filas_originales, row.filas_finales) == (n, n)
    assert (row.nulos_antes, row.nulos_despues) == (n + 1, n)  # no value at all to fill the state with
