import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.scratch import scratch_path
from millrace.sources.streams import decode_value, kafka_options, stream_files, stream_socket
from millrace.streaming import logs, run
from millrace.streaming.wordcount import word_counts

GOOD = [
    "2024-03-01 10:00:00 | INFO  | Tank filled to the mark | server-node-1",
    "2024-03-01 10:00:05 | ERROR | Valve stuck half way | server-node-2",
    "2024-03-01 10:00:09 | INFO  | Pump primed | server-node-1",
]
BAD = ["garbage", "bad ts | WARN  | x | s", "", "2024-13-01 10:00:00 | INFO  | x | server-node-1"]


def write_lines(spark, path, lines):
    spark.createDataFrame([(line,) for line in lines], ["value"]).coalesce(1).write.mode("append").text(path)


def test_parse_drops_malformed_lines(spark):
    df = spark.createDataFrame([(line,) for line in GOOD + BAD], ["value"])
    out = rows(logs.parse_lines(df))
    assert len(out) == 3
    assert out[0] == (dt.datetime(2024, 3, 1, 10, 0), "INFO", "Tank filled to the mark", "server-node-1")


def test_line_with_missing_fields_keeps_what_it_has(spark):
    df = spark.createDataFrame([("2024-03-01 10:00:00 | INFO",)], ["value"])
    assert rows(logs.parse_lines(df)) == [(dt.datetime(2024, 3, 1, 10, 0), "INFO", None, None)]


def test_render_and_parse_are_inverse(spark):
    data = [(dt.datetime(2024, 3, 1, 10, 0), "INFO", "Pump primed", 3), (dt.datetime(2024, 3, 1, 10, 1), "CRITICAL", "x", 1)]
    df = spark.createDataFrame(data, ["t", "level", "message", "n"])
    line = logs.render_line(F.col("t"), F.col("level"), F.col("message"), F.col("n"))
    lines = df.select(line.alias("value"))
    assert lines.first()[0] == "2024-03-01 10:00:00 | INFO  | Pump primed | server-node-3"
    assert rows(logs.parse_lines(lines)) == [(t, level, m, f"server-node-{n}") for t, level, m, n in data]


def test_kafka_shaped_records(spark):
    df = spark.createDataFrame([(b"k", b"three grey geese", "t", 0, 7)], ["key", "value", "topic", "partition", "offset"])
    decoded = decode_value(df, "offset")
    assert rows(decoded) == [(7, "three grey geese")] and dict(decoded.dtypes)["value"] == "string"
    assert kafka_options("h:1", "logs", 5) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "logs", "maxOffsetsPerTrigger": "5"
    }


def test_socket_source_gives_lines(spark):
    assert stream_socket(spark, "localhost", 9999).dtypes == [("value", "string")]


def test_running_word_count_equals_batch(spark):
    path, checkpoint = scratch_path(spark, "words"), scratch_path(spark, "checkpoint")
    write_lines(spark, path, ["a b a", "c"])
    write_lines(spark, path, ["b  a"])
    lines = stream_files(spark, path, logs.LINE_SCHEMA, max_files=1)
    query = run.finish(run.to_state(word_counts(lines), checkpoint, name="words"), 120)
    assert len([p for p in query.recentProgress if p["numInputRows"] > 0]) == 2
    batch = word_counts(spark.read.text(path))
    assert rows(run.read_state(spark, checkpoint)) == rows(batch) == [("", 1), ("a", 3), ("b", 2), ("c", 1)]


def test_running_summary_in_memory_and_as_state(spark):
    path, checkpoint = scratch_path(spark, "logs"), scratch_path(spark, "checkpoint")
    write_lines(spark, path, GOOD + BAD)
    parsed = logs.parse_lines(stream_files(spark, path, logs.LINE_SCHEMA))
    summary = logs.summarize(parsed).orderBy("server", "level")
    run.finish(run.to_state(summary, checkpoint, "complete"), 120)
    expected = [("server-node-1", "INFO", 2), ("server-node-2", "ERROR", 1)]
    assert rows(run.read_state(spark, checkpoint)) == expected
    shown = run.to_console(summary, "complete", scratch_path(spark, "checkpoint"), name="summary_logs")
    assert shown.name == "summary_logs"
    run.finish(shown, 120)


def test_sorted_versions_of_a_running_summary(spark):
    path, out, checkpoint = (scratch_path(spark, n) for n in ("logs", "versions", "checkpoint"))
    for lines in (GOOD, GOOD[:1]):
        write_lines(spark, path, lines)
        parsed = logs.parse_lines(stream_files(spark, path, logs.LINE_SCHEMA))
        run.finish(run.to_versions(logs.summarize(parsed), out, checkpoint, ["server", "level"]), 120)
    latest = run.read_latest(spark, out)
    assert rows(latest) == [("server-node-1", "INFO", 3, 1), ("server-node-2", "ERROR", 1, 2)]
    assert spark.read.parquet(out).select("version").distinct().count() == 2


def test_partitioned_output_restart_and_growth(spark):
    path, out, checkpoint = (scratch_path(spark, n) for n in ("logs", "out", "checkpoint"))
    write_lines(spark, path, GOOD + BAD)

    def once():
        parsed = logs.parse_lines(stream_files(spark, path, logs.LINE_SCHEMA))
        run.finish(run.to_parquet(parsed, out, checkpoint, by=("server", "level")), 120)
        return spark.read.parquet(out)

    assert once().count() == 3
    assert once().count() == 3
    write_lines(spark, path, ["2024-03-02 00:00:00 | WARN  | Filter due for a wash | server-node-5"])
    assert once().count() == 4
    plan = spark.read.parquet(out).filter("server = 'server-node-5'")
    assert plan.count() == 1 and "PartitionFilters: [isnotnull(server" in plan._jdf.queryExecution().toString()


def test_interval_trigger_and_timeout(spark):
    path, checkpoint = scratch_path(spark, "words"), scratch_path(spark, "checkpoint")
    write_lines(spark, path, ["a"])
    lines = stream_files(spark, path, logs.LINE_SCHEMA)
    query = run.to_state(word_counts(lines), checkpoint, every="1 second", name="ticking")
    query.processAllAvailable()
    spark.streams.resetTerminated()
    assert run.finish_any(spark, 1) is False
    with pytest.raises(TimeoutError):
        run.finish(query, 1)
    assert not query.isActive


def test_the_session_keeps_its_own_state_store(spark):
    path, checkpoint = scratch_path(spark, "words"), scratch_path(spark, "checkpoint")
    write_lines(spark, path, ["a"])
    before = spark.conf.get(run.STATE_STORE)
    run.finish(run.to_state(word_counts(stream_files(spark, path, logs.LINE_SCHEMA)), checkpoint), 120)
    assert spark.conf.get(run.STATE_STORE) == before
    assert rows(run.read_state(spark, checkpoint)) == [("a", 1)]
