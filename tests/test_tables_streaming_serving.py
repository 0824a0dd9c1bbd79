import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marginwatch.config import RULES
from marginwatch.operators import gates
from marginwatch.operators import validation as V
from marginwatch.plans import serving
from marginwatch.sources import events as E
from marginwatch.sources import tables as T
from marginwatch.streaming import landing
from messages import NOW, clean_stream, event, raw


# ------------------------------------------------------------------ merges, schema, publish
@pytest.fixture
def target(spark):
    df = spark.createDataFrame([("a", 1, "old", None), ("b", 2, "old", None)], "id string, qty int, payload string, updated_at timestamp")
    return spark.createDataFrame(df.collect(), df.schema)


def merged(target, source, mode):
    return {r.id: (r.qty, r.payload, r.updated_at is not None) for r in T.merge(target, source, mode, ["id"]).collect()}


def test_merge_modes(spark, target):
    source = spark.createDataFrame([("b", 20.0, "new"), ("c", 3.0, "new")], "id string, qty double, payload string")
    assert merged(target, source, "upsert") == {"a": (1, "old", False), "b": (20, "new", True), "c": (3, "new", True)}
    assert merged(target, source, "sync") == {"b": (20, "new", True), "c": (3, "new", True)} == merged(target, source, "replace")
    assert tuple(T.merge_changes(target, source, ["id"]).first()) == (1, 1, 1)
    with pytest.raises(ValueError):
        T.merge(target, source, "upsert")


def test_merge_keeps_columns_the_source_lacks_and_refuses_repeated_keys(spark):
    target = spark.createDataFrame([(1, "a", "keep"), (2, "b", "also")], "id int, v string, note string")
    source = spark.createDataFrame([(1, "x"), (3, "y")], "id int, v string")
    got = lambda mode: {tuple(r) for r in T.merge(target, source, mode, ["id"]).collect()}
    assert got("upsert") == {(1, "x", "keep"), (2, "b", "also"), (3, "y", None)}
    assert got("sync") == {(1, "x", "keep"), (3, "y", None)}
    with pytest.raises(ValueError, match="repeats the key"):
        T.merge(target, source.union(source), "upsert", ["id"])
    needed = spark.createDataFrame([], "id int not null, v string not null, note string not null").schema
    with pytest.raises(ValueError, match="missing required column note"):
        T.merge(target, source, "upsert", ["id"], schema=needed)


def test_landing_ranges_see_gaps_repeats_and_missing_ends(spark):
    rows = [("t", p, o) for p, offsets in enumerate([[0, 1, 1, 3], [0, 1, 2], [5, 6], [0, 1, 1]]) for o in offsets]
    raw = spark.createDataFrame(rows, "topic string, kafka_partition int, kafka_offset long")
    assert {r.kafka_partition: r.complete for r in gates.landing_ranges(raw).collect()} == {0: False, 1: True, 2: True, 3: False}
    planned = spark.createDataFrame([("t", 0, 0, 3), ("t", 1, 0, 2), ("t", 2, 5, 7), ("t", 3, 0, 1), ("t", 4, 0, 0), ("t", 5, 3, 2)], "topic string, kafka_partition int, first_offset long, last_offset long")
    got = {r.kafka_partition: r.complete for r in gates.landing_ranges(raw, planned).collect()}
    assert got == {0: False, 1: True, 2: False, 3: False, 4: False, 5: True}


def test_schema_drift_stops_a_load(spark):
    target = spark.createDataFrame([("a", 1)], "id string not null, qty int not null").schema
    assert T.schema_drift(spark.createDataFrame([("a", 1, 2)], "id string, qty int, extra int").schema, target) == ["unknown column extra"]
    with pytest.raises(ValueError, match="missing required column qty"):
        T.conform(spark.createDataFrame([("a",)], "id string"), target)


def test_publish_is_all_or_nothing(spark, tmp_path):
    root = str(tmp_path)
    one, two = spark.range(3).toDF("x"), spark.range(5).toDF("x")
    assert T.publish(spark, {"t": one, "u": two}, root, "r1", datetime(2025, 1, 1)) == {"t": 3, "u": 5}
    bad = two.select(F.raise_error(F.lit("boom")).cast("bigint").alias("x"))
    with pytest.raises(Exception, match="boom"):
        T.publish(spark, {"t": two, "u": bad}, root, "r2", datetime(2025, 1, 2))
    assert T.current_version(spark, root) == "r1" and T.read_published(spark, root, "t").count() == 3
    with pytest.raises(RuntimeError):
        T.verify_counts({"fact_sales": 2, "dim_date": 1}, {"fact_sales": 1, "dim_date": 9}, exempt="dim_")
    T.verify_counts({"dim_date": 1}, {"dim_date": 9}, exempt="dim_")


def test_run_log(spark, tmp_path):
    log = T.RunLog(spark, f"{tmp_path}/runs")
    log.stage("1", "clean", lambda: {"rows_in": 5, "rows_out": 4, "rows_rejected": 1})
    with pytest.raises(KeyError):
        log.stage("2", "load", lambda: {}["x" * 5000])
    rows = {r.stage: r for r in log.read().collect()}
    assert rows["clean"].status == "SUCCESS" and rows["clean"].rows_rejected == 1
    assert rows["load"].status == "FAILED" and len(rows["load"].error) == 2000


# ------------------------------------------------------------------ sources
def test_csv_to_messages_keeps_bad_numbers_as_text(spark, tmp_path):
    e = {**event(1), "quantity": "many", "unit_cost": "1.50", "city": 'Kar"achi'}
    columns = [c for c in e if c != "schema_version"]
    spark.createDataFrame([tuple("" if e[c] is None else str(e[c]) for c in columns)], ", ".join(f"{c} string" for c in columns)).write.option(
        "header", True).option("escape", '"').csv(f"{tmp_path}/csv")
    row = E.encode_events(spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/csv").unionByName(
        E.read_event_csv(spark, f"{tmp_path}/csv").limit(0))).first()
    body = json.loads(row.value)
    assert body["quantity"] == "many" and body["unit_cost"] == 1.5 and body["city"] == 'Kar"achi' and body["return_reason"] is None
    assert body["schema_version"] == 1 and row.topic == "retail.sales" and row.key == "BR01"


def test_messages_are_the_same_whether_written_whole_or_by_field(spark):
    """One bad number makes a row go field by field; the other fields read the same either way."""
    numbers = ["0.10", "100.00", "12345678.9", "0.0004", "-0.50", "7", "1e3"]
    texts = ['Kar"achi', "tab\there", "back\\slash", "Łódź", "\u2028", "plain", "x\u0001y"]
    rows = [{**event(i), "unit_cost": n, "city": t} for i, (n, t) in enumerate(zip(numbers, texts))]
    columns = [c for c in rows[0] if c != "schema_version"]
    table = lambda rs: spark.createDataFrame([tuple(None if r[c] is None else str(r[c]) for c in columns) for r in rs], ", ".join(f"{c} string" for c in columns))
    body = lambda r: json.loads(r.value)
    whole = {body(r)["event_id"]: r.value for r in E.encode_events(table(rows)).collect()}
    pieces = {body(r)["event_id"]: r.value for r in E.encode_events(table([{**r, "quantity": "many"} for r in rows])).collect()}
    assert {k: v.replace('"quantity":2', '"quantity":"many"') for k, v in whole.items()} == pieces and len(whole) == 7
    plan = E.encode_events(table(rows))._jdf.queryExecution().optimizedPlan().toString()
    assert "to_json(" in plan.lower() or "structstojson" in plan.lower()


def test_streaming_judges_a_batch_once_and_keeps_payloads(spark, tmp_path):
    src = f"{tmp_path}/src"
    events = clean_stream() + [{**event(3), "city": "Atlantis", "event_id": "EVT0000099"}, {**event(50), "quantity": -1}, "broken"]
    messages = raw(spark, events)
    messages.write.parquet(src)
    known = V.masters(V.parse_events(messages), RULES)
    calls, real = [], V.parse_events
    V.parse_events = lambda *a, **k: calls.append(1) or real(*a, **k)
    try:
        landing.validate_stream(landing.message_stream(spark, {"format": "parquet", "path": src}), RULES, NOW, known,
                                f"{tmp_path}/ok", f"{tmp_path}/bad", f"{tmp_path}/cp").awaitTermination()
    finally:
        V.parse_events = real
    values = {r.kafka_offset: r.value for r in messages.collect()}
    bad = spark.read.parquet(f"{tmp_path}/bad").collect()
    assert {r.rule_code for r in bad} >= {"BRANCH_CITY_CONFLICT", "INVALID_QUANTITY", "MALFORMED_PAYLOAD"}
    assert all(r.raw_payload == values[r.kafka_offset] for r in bad)
    # What was judged is written once, and gone when the batch is done.
    assert len(calls) == 1 and spark.read.parquet(f"{tmp_path}/cp-first-pass").count() == 0


def test_routing(spark):
    df = spark.createDataFrame([("SALE",), ("DAMAGE",), ("REFUND",), (None,)], "t string").select(E.route(F.col("t")).alias("r"))
    assert [r.r for r in df.collect()] == ["sales", "inventory", "dead_letter", "dead_letter"]


# ------------------------------------------------------------------ streaming
def test_landing_is_incremental_and_replay_safe(spark, tmp_path):
    src, out, cp = (f"{tmp_path}/{n}" for n in ("src", "raw", "cp"))
    events = raw(spark, clean_stream())
    for part in (events.where("kafka_offset < 10"), events.where("kafka_offset >= 10")):
        part.write.mode("append").parquet(src)
        landing.land(landing.message_stream(spark, {"format": "parquet", "path": src}), out, cp).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 24 and got.select("ingest_batch").distinct().count() == 2
    assert gates.landing_ranges(got).where("not complete").count() == 0
    assert landing.registered(got, got.where("ingest_batch = 0").select("ingest_batch").distinct()).count() == 10


def test_stream_validation_and_first_copies(spark, tmp_path):
    src = f"{tmp_path}/src"
    events = clean_stream() + [event(3), {**event(50), "quantity": -1}, "broken"]
    messages = raw(spark, events)
    messages.write.parquet(src)
    known = V.masters(V.parse_events(messages), RULES)
    stream = landing.message_stream(spark, {"format": "parquet", "path": src})
    landing.validate_stream(stream, RULES, NOW, known, f"{tmp_path}/ok", f"{tmp_path}/bad", f"{tmp_path}/cp").awaitTermination()
    ok, bad = spark.read.parquet(f"{tmp_path}/ok"), spark.read.parquet(f"{tmp_path}/bad")
    assert ok.count() == 25 and {r.rule_code for r in bad.collect()} >= {"INVALID_QUANTITY", "MALFORMED_PAYLOAD"}
    accepted = spark.readStream.schema(ok.drop("ingest_batch").schema).parquet(f"{tmp_path}/ok")
    q = (landing.first_copies(accepted).writeStream.format("memory").queryName("firsts").option("checkpointLocation", f"{tmp_path}/cp2")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("firsts").count() == 24


def test_state_of_first_copies_expires(spark, tmp_path):
    """Events in the order of their time: a copy within the week is dropped, and ids older than it leave the state."""
    schema = "event_id string, kafka_timestamp timestamp_ntz"
    removed = []
    for day in (0, 3, 20, 40):
        rows = [(f"E{day}-{k}", NOW + timedelta(days=day)) for k in range(5)] + [("E0-0", NOW + timedelta(days=day))] * (day == 3)
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        q = (landing.first_copies(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), "7 days").writeStream.format("parquet")
             .option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start())
        q.awaitTermination()
        removed.append(sum(o["numRowsRemoved"] for p in q.recentProgress for o in p["stateOperators"]))
    out = [r.event_id for r in spark.read.schema(schema).parquet(f"{tmp_path}/out").collect()]
    assert len(out) == 20 and out.count("E0-0") == 1
    assert removed[0] == removed[1] == 0 and sum(removed) >= 10


# ------------------------------------------------------------------ gates and serving
def test_gates_are_stored_before_they_are_enforced(spark, tmp_path):
    frame = lambda *rows: spark.createDataFrame([("w", n, "CRITICAL", s, o, 0.0, f"observed {o}") for n, s, o in rows], "layer string, check_name string, severity string, status string, observed double, expected double, message string")
    history = f"{tmp_path}/history"
    gates.settle(frame(("A", "PASS", 0.0)), history, "r1", NOW)
    with pytest.raises(RuntimeError, match="B"):
        gates.settle(frame(("A", "PASS", 0.0), ("B", "FAIL", 3.0)), history, "r2", NOW)
    gates.settle(frame(("B", "PASS", 0.0)), history, "r3", NOW)  # an earlier run's failure does not stop a later one
    stored = gates.gate_history(spark, history).collect()
    assert sorted((r.run_id, r.check_name, r.status) for r in stored) == [("r1", "A", "PASS"), ("r2", "A", "PASS"), ("r2", "B", "FAIL"), ("r3", "B", "PASS")]


def test_coverage_matrix_is_one_aggregation(spark):
    df = spark.createDataFrame([("B1", "x", 0.0), ("B1", "y", 10.0), ("B2", "x", 5.0), ("B2", "y", None)], "branch_id string, category string, replenishment_ratio double")
    cells = {r.branch_id: r.cells for r in serving.coverage_matrix(df).collect()}
    assert cells == {"B1": {"x": 0.0, "y": 1.0}, "B2": {"x": 0.5, "y": None}}
    assert serving.coverage_matrix(df, ["y", "z"]).columns == ["branch_id", "y", "z"]
    assert "Pivot" not in serving.coverage_matrix(df)._jdf.queryExecution().analyzed().toString()


def test_enforce_raises_only_on_critical(spark):
    rows = [("w", "A", "CRITICAL", "PASS", ""), ("w", "B", "WARNING", "WARN", "")]
    df = spark.createDataFrame(rows, "layer string, check_name string, severity string, status string, message string")
    gates.enforce(df)
    with pytest.raises(RuntimeError, match="C"):
        gates.enforce(df.union(spark.createDataFrame([("w", "C", "CRITICAL", "FAIL", "x")], df.schema)))


def test_freshness(spark):
    runs = T.run_record(spark, "1", "ingest", "SUCCESS", NOW, NOW)
    status = {r.check_name: r.status for r in gates.freshness_gates(runs, NOW).collect()}
    assert status == {"FRESH_INGEST_RUN": "PASS", "FRESH_CLEAN_RUN": "WARN", "FRESH_TRANSFORM_RUN": "WARN", "FRESH_LOAD_RUN": "WARN"}


def test_other_branches_median_matches_brute_force(spark):
    values = {"A": 1.0, "B": 1.0, "C": 5.0, "D": None, "E": 9.0, "F": 2.0}
    df = spark.createDataFrame([(b, "2025-01", v) for b, v in values.items()] + [("A", "2025-02", 4.0)], "branch_id string, year_month string, m double")
    got = {(r.branch_id, r.year_month): r.others_median for r in serving.other_branches_median(df, "m").collect()}
    for b in values:
        rest = sorted(v for k, v in values.items() if k != b and v is not None)
        assert got[b, "2025-01"] == rest[len(rest) // 2]
    assert got["A", "2025-02"] is None


def test_anomaly_feed_order(spark):
    rows = [("a", "branch", "medium", 9.0, "X"), ("b", "branch", "critical", None, None), ("c", "product", "critical", 5.0, "X")]
    df = spark.createDataFrame(rows, "anomaly_id string, entity_type string, severity string, estimated_exposure double, leakage_type string")
    assert [r.anomaly_id for r in serving.anomaly_feed(df).collect()] == ["c", "b", "a"]
    assert [r.anomaly_id for r in serving.anomaly_feed(df, leakage_only=True, limit=1).collect()] == ["c"]
