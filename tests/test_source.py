from pyspark.sql import functions as F

from marginwatch.plans.retail import Workspace

DIR = "/root/testdata/sf0.001"


def test_source_is_stored_without_event_ids_and_gives_the_same(spark):
    w = Workspace.of(spark, DIR)
    rows = w.source()
    assert "event_id" not in w.staged["source"].columns
    assert rows.columns[0] == "event_id" and not {"line", "shipped"} & set(rows.columns)
    line = spark.read.parquet(f"{DIR}/lineitem.parquet").selectExpr(
        "md5(cast(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, int(l_quantity), cast(l_shipdate as timestamp_ntz)) as binary)) as event_id")
    price = spark.read.parquet(f"{DIR}/part.parquet").selectExpr("md5(cast(concat('price|', p_partkey) as binary)) as event_id")
    wanted = line.unionByName(price).agg(F.count("*"), F.sum(F.xxhash64("event_id").cast("decimal(38,0)"))).first()
    assert tuple(wanted) == tuple(rows.agg(F.count("*"), F.sum(F.xxhash64("event_id").cast("decimal(38,0)"))).first())
    plan = rows.select("product_id", "quantity")._jdf.queryExecution().executedPlan().toString()
    assert "md5" not in plan and "shipped" not in plan


def test_accepted_events_are_written_once_for_the_gates(spark):
    w = Workspace.of(spark, DIR)
    events = w.clean_events()
    assert "clean_events" in w.staged and events.count() == w.account().first().accepted
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "try_to_timestamp" not in plan
