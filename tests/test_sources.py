"""CSV contract source (batch and streaming) and sink helpers."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators.expect import ContractError
from shelfwise.sources import contract as K
from shelfwise.sources import fixtures as FX
from shelfwise.sources import sinks as S
from shelfwise.streaming.ingest import append_to_stage, contract_stream

SF = "/root/testdata/sf0.001"


def _tmp():
    return tempfile.mkdtemp(prefix="shelfwise-test-", dir="/tmp")


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_csv_roundtrip_of_the_inputs(spark):
    root = _tmp()
    inputs = FX.retail_inputs(FX.Tables(spark, SF))
    for name, df in inputs.items():
        if name == "train":
            df = df.withColumn("id", F.monotonically_increasing_id())
        # columns in another order and one extra column are both allowed
        df = df.select(*reversed(df.columns), F.lit("x").alias("extra"))
        df.coalesce(1).write.option("header", True).csv(f"{root}/{K.FILES[name]}")
    loaded = K.load_sources(spark, root)
    for name, df in inputs.items():
        got = loaded[name].select(*df.columns)
        assert got.schema.simpleString().count("date") == df.schema.simpleString().count("date")
        assert got.exceptAll(df.select(*[F.col(c).cast(got.schema[c].dataType) for c in df.columns])).count() == 0
        assert got.count() == df.count()


def test_missing_file_and_column(spark):
    root = _tmp()
    with pytest.raises(FileNotFoundError):
        K.read_contract(spark, f"{root}/nope.csv", K.CONTRACTS["oil"])
    spark.createDataFrame([("2020-01-01",)], "date string").coalesce(1).write.option("header", True).csv(f"{root}/oil.csv")
    with pytest.raises(ContractError, match="dcoilwtico"):
        K.read_contract(spark, f"{root}/oil.csv", K.CONTRACTS["oil"])


def test_bad_value_fails(spark):
    root = _tmp()
    spark.createDataFrame([("2020-01-01", "abc")], "date string, dcoilwtico string").coalesce(1) \
        .write.option("header", True).csv(f"{root}/oil.csv")
    with pytest.raises(Exception):
        K.read_contract(spark, f"{root}/oil.csv", K.CONTRACTS["oil"]).collect()


def test_stream_ingest(spark):
    root = _tmp()
    src = f"{root}/in"
    spark.createDataFrame([("2020-01-01", "1.5"), ("2020-01-02", None)], "date string, dcoilwtico string") \
        .coalesce(1).write.option("header", True).csv(src)
    q = append_to_stage(contract_stream(spark, src, ["date", "dcoilwtico"], K.CONTRACTS["oil"]),
                        f"{root}/out", f"{root}/ckpt")
    q.awaitTermination(120)
    out = spark.read.parquet(f"{root}/out")
    assert out.schema["date"].dataType == T.DateType()
    assert sorted((r.date.isoformat(), r.dcoilwtico) for r in out.collect()) == [
        ("2020-01-01", 1.5), ("2020-01-02", None)]


def test_sink_helpers(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("d", T.DateType()),
                           T.StructField("x", T.DecimalType(10, 2)), T.StructField("s", T.StringType())])
    assert S.create_table_ddl("public", "t", schema) == (
        'CREATE TABLE "public"."t" ("a" BIGINT, "d" DATE, "x" NUMERIC(10,2), "s" TEXT)')
    with pytest.raises(ValueError):
        S.quote_identifier("bad name")
    with pytest.raises(TypeError):
        S.sql_type(T.ArrayType(T.IntegerType()))
    ddl = S.index_ddl("public", "ventas_por_tienda", ["store_nbr", "ventas_totales"])
    assert ddl == ['CREATE INDEX IF NOT EXISTS "idx_ventas_por_tienda_store_nbr" ON "public"."ventas_por_tienda" ("store_nbr")']
    assert S.index_ddl("public", "consolidado", ["date"]) == [
        'CREATE INDEX IF NOT EXISTS "idx_consolidado_date" ON "public"."consolidado" ("date")']
    df = spark.createDataFrame([(1,)], "a bigint")
    opts = S.jdbc_options("jdbc:postgresql://db/x", "public", S.staging_table("t", "r"))
    assert "createTableColumnTypes" not in opts
    assert opts["batchsize"] == "50000" and opts["dbtable"] == '"public"."t__staging_r"'
    with pytest.raises(FileNotFoundError):
        S.require_complete({"a": df, "b": None}, ["a", "b"])


class Target:
    """A database of one staging table, which a task may fill twice."""

    def __init__(self, again=()):
        self.seen, self.held, self.again = [], 0, list(again)

    def execute(self, spark, url, statements, properties):
        self.seen.append(statements)
        if any(s.startswith("CREATE TABLE") for s in statements):
            self.held = 0

    def count(self, spark, url, dbtable, properties):
        self.seen.append(("count", dbtable))
        return self.held


@pytest.fixture
def appends(monkeypatch):
    """Let the JDBC writer count rows instead of sending them."""
    from pyspark.sql import DataFrameWriter

    def into(target):
        def save(self, *a, **k):
            target.seen.append("append")
            rows = self._df.collect()
            target.held += len(rows) + (target.again.pop(0) if target.again else 0)
        monkeypatch.setattr(DataFrameWriter, "save", save)
        return target
    return into


def stores(spark):
    return spark.createDataFrame([(k, 1.5) for k in range(7)], "store_nbr bigint, ventas_totales double").repartition(3)


def test_export_statements_in_order(spark, appends):
    """The staging table exists before the write; rows are counted; swap, indexes and statistics follow as one unit."""
    t = appends(Target())
    assert S.write_jdbc(stores(spark), "jdbc:x", "public", "ventas_por_tienda", run="r1", execute=t.execute, count=t.count) == 7
    before, write, count, after = t.seen
    staging = '"public"."ventas_por_tienda__staging_r1"'
    assert [s.split(" (")[0] for s in before] == ['CREATE SCHEMA IF NOT EXISTS "public"', f"DROP TABLE IF EXISTS {staging}", f"CREATE TABLE {staging}"]
    assert "DOUBLE PRECISION" in before[-1]
    assert (write, count) == ("append", ("count", staging))
    assert after == ['DROP TABLE IF EXISTS "public"."ventas_por_tienda"', f'ALTER TABLE {staging} RENAME TO "ventas_por_tienda"',
                     'CREATE INDEX IF NOT EXISTS "idx_ventas_por_tienda_store_nbr" ON "public"."ventas_por_tienda" ("store_nbr")', 'ANALYZE "public"."ventas_por_tienda"']
    assert S.index_ddl("public", "ventas_por_mes", ["anio", "mes"])[0].endswith('("anio", "mes")')


def test_rows_appended_twice_stop_before_the_swap(spark, appends):
    t = appends(Target(again=[2, 3]))
    with pytest.raises(S.IncompleteExport, match="7 rows sent, 10 in the staging table"):
        S.write_jdbc(stores(spark), "jdbc:x", "public", "ventas_por_tienda", run="r2", execute=t.execute, count=t.count)
    assert not any("RENAME" in s for x in t.seen if isinstance(x, list) for s in x)
    assert t.seen[-1] == ['DROP TABLE IF EXISTS "public"."ventas_por_tienda__staging_r2"']


def test_a_second_attempt_is_swapped_in(spark, appends):
    t = appends(Target(again=[2]))
    assert S.write_jdbc(stores(spark), "jdbc:x", "public", "ventas_por_tienda", execute=t.execute, count=t.count) == 7
    assert t.seen.count("append") == 2 and "RENAME" in t.seen[-1][1]


def test_stage_tables_keep_their_counts(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    out = S.stage_table(df, "counted", "k1")
    assert S.staged_counts(spark, "counted", "k1") == {"rows": 2, "nulls": 1}
    assert out.count() == 2 and S.written_bytes(spark, S.stage_path(spark, "counted", "k1")) > 0

    def stop(counts):
        raise ValueError(f"{counts['rows']} rows")
    with pytest.raises(ValueError, match="2 rows"):
        S.stage_table(df, "counted", "k2", check=stop)
    with pytest.raises(KeyError):
        S.staged_counts(spark, "counted", "k2")


def test_partitioned_tables(spark):
    root = _tmp()
    df = spark.range(600).selectExpr("id % 3 as m", "id as v").repartition(7)
    S.write_table(df, f"{root}/t", partition_by=["m"], sort_by=["v"])
    assert sorted(x for x in os.listdir(f"{root}/t") if x.startswith("m=")) == ["m=0", "m=1", "m=2"]
    assert all(len([f for f in os.listdir(f"{root}/t/m={m}") if f.endswith(".parquet")]) == 1 for m in range(3))
    assert spark.read.parquet(f"{root}/t").count() == 600


def test_manifest_counts_during_write(spark):
    root = _tmp()
    df = spark.range(25).withColumn("y", F.col("id") * 2)
    (row,) = S.write_with_manifest({"t": df}, root)
    assert (row["tabla"], row["filas"], row["columnas"]) == ("t", 25, 2)
    assert spark.read.parquet(f"{root}/t").count() == 25


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_pipeline_writes_all_tables(spark):
    from shelfwise.plans.pipeline import RESULT_TABLES, run
    root = _tmp()
    rows = run(spark, SF, root)
    names = [r["tabla"] for r in rows]
    assert names[:-1] == list(RESULT_TABLES) and names[-1] == "TOTAL"
    fact = spark.read.parquet(f"{root}/consolidado")
    assert fact.count() == rows[0]["filas"] and len(fact.columns) == 19
    months = [r.fecha_mes for r in spark.read.parquet(f"{root}/ventas_por_mes").collect()]
    assert months == sorted(months)  # row order kept in the written file


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_export_sends_every_table_in_order(spark):
    from shelfwise.plans.pipeline import RESULT_TABLES, export

    seen = []

    def write(df, url, schema_name, table, properties):
        seen.append((url, schema_name, table, properties))
        return df.count()
    rows = export(spark, SF, "jdbc:x", properties={"user": "u"}, write=write)
    assert [s[2] for s in seen] == list(RESULT_TABLES) and set(s[:2] for s in seen) == {("jdbc:x", "public")} and seen[0][3] == {"user": "u"}
    assert all(r["filas"] > 0 for r in rows)


def test_register_and_analyze(spark):
    root = _tmp()
    spark.range(40).withColumn("k", F.col("id") % 4).write.parquet(f"{root}/t")
    t = S.register_and_analyze(spark, "shelfwise_test_t", f"{root}/t")
    assert t.count() == 40
    desc = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED shelfwise_test_t").collect()}
    assert "40 rows" in desc.get("Statistics", "")
    col = {r.info_name: r.info_value for r in spark.sql("DESCRIBE TABLE EXTENDED shelfwise_test_t k").collect()}
    assert col["distinct_count"] == "4" and col["max"] == "3"


def test_written_tables_are_registered_with_the_statistics_of_their_plans(spark):
    from shelfwise.plans import pipeline
    root, was = _tmp(), spark.conf.get("spark.sql.cbo.enabled")
    rows = pipeline.run(spark, SF, root)
    try:
        tables = pipeline.register(spark, root, rows)
        counts = {r["tabla"]: r["filas"] for r in rows if r["tabla"] != "TOTAL"}
        assert {name: S.estimated_rows(df) for name, df in tables.items()} == counts
        stores = tables["ventas_por_tienda"]
        assert S.estimated_rows(stores.where("store_nbr is null")) == 0  # from the column's statistics
        one = S.estimated_rows(tables["transacciones_ventas_diarias"].where("store_nbr = 1"))
        assert one == pytest.approx(counts["transacciones_ventas_diarias"] / stores.count(), rel=0.2)
        with pytest.raises(RuntimeError, match="consolidado"):
            pipeline.register(spark, root, [{**r, "filas": r["filas"] + 1} for r in rows])
    finally:
        spark.conf.set("spark.sql.cbo.enabled", was)
        for name in pipeline.RESULT_TABLES:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
