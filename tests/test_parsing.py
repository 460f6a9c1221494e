from datetime import datetime

import pytest
from log_lines import HDFS_LINE, STANDARD_LINE
from pyspark.sql import functions as F

from loghelm.functions.text import block_id, encode_label, has_any_word, is_blank, log_id, parse_lines, sanitize, strip


def parse(spark, *lines, **options):
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "line_no long, value string")
    return parse_lines(df, ingest_ts=F.lit(datetime(2026, 1, 2, 3, 4, 5, 678)), **options).orderBy("line_no").collect()


def one(spark, text, fn):
    return spark.createDataFrame([(text,)], "t string").select(fn(F.col("t")).alias("o")).first()["o"]


def test_hdfs_line(spark):
    row = parse(spark, HDFS_LINE)[0]
    assert row["format"] == "hdfs"
    assert row["level"] == "WARN"
    assert row["source"] == "dfs.DataNode$BlockReceiver"
    assert row["block_id"] == "blk_-77301"
    assert row["template"] == "Mirror of block <BLOCK> lost between <IP> and <IP>"
    assert row["timestamp"] == "2012-07-03T11:42:59+00:00"
    assert row["event_ts"] == datetime(2012, 7, 3, 11, 42, 59)


def test_hdfs_line_with_impossible_date_uses_ingest_time(spark):
    row = parse(spark, "081309 203518 143 INFO a.b: text")[0]
    assert row["format"] == "hdfs"
    assert row["event_ts"] is None
    assert row["timestamp"] == "2026-01-02T03:04:05.000678+00:00"


def test_standard_line(spark):
    row = parse(spark, "  " + STANDARD_LINE + " \t")[0]
    assert (row["format"], row["level"], row["source"]) == ("standard", "ERROR", "billing")
    assert row["message"] == "worker stopped, no heap space left"
    assert row["raw_text"] == STANDARD_LINE
    assert row["timestamp"] == "2025-02-11T06:31:07Z"


@pytest.mark.parametrize(
    ("stamp", "second"),
    [
        ("2021-08-30 21:15:40", datetime(2021, 8, 30, 21, 15, 40)),
        ("2019-12-01T03:07:55.25", datetime(2019, 12, 1, 3, 7, 55)),
        ("2023-04-17T18:42:09.640215Z", datetime(2023, 4, 17, 18, 42, 9)),
    ],
)
def test_standard_time_shapes(spark, stamp, second):
    row = parse(spark, f"{stamp} [WARN] [a-b.c_1]: m")[0]
    assert row["format"] == "standard"
    assert row["timestamp"] == stamp
    assert row["event_ts"].replace(microsecond=0) == second


def test_raw_line(spark):
    row = parse(spark, "just text 7")[0]
    assert (row["format"], row["level"], row["source"], row["message"]) == ("raw", "INFO", "unknown", "just text 7")
    assert row["template"] == "just text <NUM>"
    assert row["event_ts"] is None


def test_offset_times_are_raw_unless_accepted(spark):
    line = "2022-03-19T11:02:48.118340+00:00 [WARN] [ledger-8]: Received block blk_74 of size 67"
    compat = parse(spark, line)[0]
    assert compat["format"] == "raw"
    assert compat["template"] == (
        "<NUM>-<NUM>-19T11:<NUM>:<NUM>.<NUM>+<NUM>:<NUM> [WARN] [ledger-<NUM>]: Received block <BLOCK> of size <NUM>"
    )
    accepted = parse(spark, line, accept_offsets=True)[0]
    assert (accepted["format"], accepted["level"]) == ("standard", "WARN")
    assert accepted["template"] == "Received block <BLOCK> of size <NUM>"


@pytest.mark.parametrize(
    ("text", "template"),
    [
        ("reserved item_4153", "reserved item_4153"),
        ("status=200 duration=18ms v1", "status=<NUM> duration=18ms v1"),
        ("from 10.0.0.1", "from <NUM>.<NUM>.<NUM>.<NUM>"),
        ("from /10.0.0.1:80 and /10.0.0.2", "from <IP> and <IP>"),
        ("at 0xDEADbeef x 12", "at <HEX> x <NUM>"),
        ("blk_-12 blk_7", "<BLOCK> <BLOCK>"),
        (" ٣٤ é5 ", "<NUM> é5"),
    ],
)
def test_sanitize(spark, text, template):
    assert one(spark, text, sanitize) == template


def test_small_functions(spark):
    assert one(spark, "x blk_1 blk_2", block_id) == "blk_1"
    assert one(spark, "none", block_id) is None
    assert one(spark, "　 a b\x1f\xa0", strip) == "a b"
    assert one(spark, " \t\x85", is_blank) is True
    assert one(spark, " . ", is_blank) is False
    assert [one(spark, t, encode_label) for t in ("Anomaly", "Normal", "other")] == [1, 0, -1]
    assert spark.range(1).select(log_id(F.lit(761)).alias("i")).first()["i"] == "log_0000761"
    assert spark.range(1).select(log_id(F.lit(123456789)).alias("i")).first()["i"] == "log_123456789"


@pytest.mark.parametrize(
    ("text", "hit"),
    [("HikariPool-1 gone", True), ("[CRITICAL] x", True), ("connection TimeOut", True), ("all well", False)],
)
def test_alert_words(spark, text, hit):
    assert one(spark, text, has_any_word) is hit


def test_parsing_is_free_of_python(spark):
    df = spark.createDataFrame([(HDFS_LINE,)], "value string")
    assert "Python" not in parse_lines(df)._jdf.queryExecution().toString()
