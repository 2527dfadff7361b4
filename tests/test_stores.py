"""Files: event logs, result stores, reports, ledger, incremental intake."""

import json

from pyspark.sql import functions as F

from sessionloom.sources import events as source
from sessionloom.sources import stores
from sessionloom.streaming.ingest import ingest


def write_events(path, rows):
    path.mkdir(exist_ok=True)
    name = path / f"part-{len(list(path.iterdir()))}.json"
    name.write_text("\n".join(json.dumps(r) for r in rows))


def event(i, payload='{"k": 1}'):
    return {"session_id": "s", "kind": "click", "ordinal": i, "event_id": f"e{i}", "server_ms": 1.0, "client_ms": 1.7e12 + i, "payload": payload}


def test_event_log_and_bad_json(spark, tmp_path):
    write_events(tmp_path / "in", [event(0), event(1, "not json"), event(2, '{"k": 5}')])
    df = source.parse_payload(source.read_events(spark, str(tmp_path / "in")), "k INT")
    got = {r["event_id"]: (r["data"]["k"] if r["data"] else None, r["raw"]) for r in df.collect()}
    assert got == {"e0": (1, None), "e1": (None, "not json"), "e2": (5, None)}
    files = source.list_files(spark, str(tmp_path / "in")).collect()
    assert len(files) == 1 and files[0]["size_bytes"] > 0


def test_incremental_intake_takes_each_file_once(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    write_events(src, [event(0), event(1)])
    ingest(spark, str(src), out, state).awaitTermination()
    write_events(src, [event(2)])
    ingest(spark, str(src), out, state).awaitTermination()
    ingest(spark, str(src), out, state).awaitTermination()
    assert sorted(r["event_id"] for r in spark.read.parquet(out).collect()) == ["e0", "e1", "e2"]


def test_result_store_replaces_only_written_sessions(spark, tmp_path):
    path = str(tmp_path / "res")
    a = spark.range(100).select((F.col("id") % 3).alias("session_id"), F.col("id").alias("v"))
    stores.save_results(a, path)
    stores.save_results(spark.range(5).select(F.lit(1).cast("long").alias("session_id"), F.col("id").alias("v")), path)
    got = {r["session_id"]: r["n_rows"] for r in stores.session_index(stores.load_results(spark, path)).collect()}
    assert got == {0: 34, 1: 5, 2: 33}
    assert stores.label_map_table(spark, {"b": 1, "a": 0}).orderBy("pattern_ord").first()["pattern"] == "b"


def test_result_store_writes_a_small_session_as_one_file(spark, tmp_path):
    path = str(tmp_path / "res")
    stores.save_results(spark.range(0, 3000, 1, 8).select((F.col("id") % 20).alias("session_id"), F.col("id").alias("v")), path)
    assert len(stores.load_results(spark, path).inputFiles()) == 20
    assert stores.load_results(spark, path).groupBy("session_id").count().where("count = 150").count() == 20


def test_ledger_reset(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    rows = spark.createDataFrame([(1, "a", "success", 1, 1), (2, "b", "failed", 2, 2)], "data_id long, transform_id string, status string, ts_ms long, seq long")
    stores.append_ledger(rows, old)
    assert stores.reset_transform(spark, old, new, "a") == 1
    assert [r["transform_id"] for r in spark.read.parquet(new).collect()] == ["b"]
    assert spark.read.parquet(old).count() == 2


def test_reports(spark, tmp_path):
    per = spark.createDataFrame([(1, 5)], "session_id long, n long")
    stores.save_reports(per, str(tmp_path / "rep"))
    assert json.loads(stores.reports(per).first()["report"]) == {"session_id": 1, "n": 5}
    assert spark.read.json(str(tmp_path / "rep")).count() == 1
