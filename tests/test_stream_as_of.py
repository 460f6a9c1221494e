import random

import pytest
from pyspark.sql import functions as F

from loghelm.operators.host_metrics import metrics_as_of
from loghelm.streaming import as_of
from loghelm.streaming.as_of import run_metrics_as_of

ALERTS = "host string, ts timestamp, log_id string, score double, seen timestamp"
METRICS = "host string, ts timestamp, cpu_percent double, memory_percent double"


def at(column):
    return F.timestamp_micros(F.col(column).cast("long"))


class Streams:
    """Both streams as folders of files, run by the job after each batch of files."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.alerts, self.samples = spark, folder, [], []

    def add(self, alerts=(), samples=(), **settings):
        """Alerts (host, microseconds, id), samples (host, microseconds, cpu, memory); returns the ids answered so far."""
        self.alerts += alerts
        self.samples += samples
        for rows, schema, name in ((alerts, "host string, ts long, log_id string", "alerts"), (samples, "host string, ts long, cpu_percent double, memory_percent double", "samples")):
            df = self.spark.createDataFrame(list(rows), schema).withColumn("ts", at("ts"))
            self.typed(df, name).coalesce(1).write.mode("append").parquet(f"{self.folder}/{name}")
        streams = [self.spark.readStream.schema(s).parquet(f"{self.folder}/{n}") for s, n in ((ALERTS, "alerts"), (METRICS, "samples"))]
        settings = {"delay": "10 seconds", "keep": "60 seconds", **settings}
        run_metrics_as_of(*streams, f"{self.folder}/out", f"{self.folder}/mark", **settings).awaitTermination()
        return sorted(r["log_id"] for r in self.found().collect())

    def typed(self, df, name):
        return df.withColumns({"score": F.lit(0.1), "seen": F.lit("2025-01-01 00:00:00.123456").cast("timestamp")}) if name == "alerts" else df

    def found(self):
        return self.spark.read.parquet(f"{self.folder}/out")

    def batch(self):
        alerts = self.typed(self.spark.createDataFrame(self.alerts, "host string, ts long, log_id string").withColumn("ts", at("ts")), "alerts")
        samples = self.spark.createDataFrame(self.samples, "host string, ts long, cpu_percent double, memory_percent double").withColumn("ts", at("ts"))
        return metrics_as_of(alerts, samples)


def rows(df):
    names = ("log_id", "host", "ts", "score", "seen", "cpu_percent", "memory_percent")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


SECOND = 1_000_000
DAY = 1_735_689_600 * SECOND


def s(n):
    return DAY + int(n * SECOND)


def test_alert_waits_for_a_late_sample_and_survives_a_restart(spark, tmp_path):
    streams = Streams(spark, tmp_path)
    assert streams.add([("h", s(100), "a")], [("h", s(90), 1.0, 2.0), ("g", s(105), 5.0, 5.0)]) == []
    assert streams.add([], [("h", s(99), 3.0, 4.0)]) == []
    # another host's sample moves the time on; the timer of the silent host wakes it
    assert streams.add([], [("g", s(111), 6.0, 6.0)]) == ["a"]
    assert [(r["cpu_percent"], r["memory_percent"]) for r in streams.found().collect()] == [(3.0, 4.0)]
    assert rows(streams.found()) == rows(streams.batch())


def test_late_alerts_are_answered_at_once(spark, tmp_path):
    streams = Streams(spark, tmp_path)
    streams.add([], [("h", s(t), float(t), 0.0) for t in range(0, 200, 10)])
    streams.add([], [("h", s(195), 195.0, 0.0)])  # lets go of the samples before 120
    got = streams.add([("h", s(155), "late"), ("h", s(5), "before the samples held"), ("x", s(1), "unknown host")], [])
    assert got == ["before the samples held", "late", "unknown host"]
    values = {r["log_id"]: r["cpu_percent"] for r in streams.found().collect()}
    assert values == {"late": 150.0, "before the samples held": None, "unknown host": None}


def test_ties_nulls_and_repeated_rows(spark, tmp_path):
    streams = Streams(spark, tmp_path)
    alerts = [("h", s(10), "a"), ("h", s(10), "a"), (None, s(10), "n"), ("h", s(50), "e")]
    samples = [("h", s(10), 1.0, None), ("h", s(10), 1.0, -2.0), ("h", s(10), None, 9.0), (None, s(9), 7.0, 7.0), ("h", s(50), None, None)]
    streams.add(alerts, samples)
    streams.add([], [("g", s(100), 0.0, 0.0)])
    assert rows(streams.found()) == rows(streams.batch())
    streams.add([("h", None, "timeless")], [("h", None, 4.0, 4.0)])
    last = streams.found().where("log_id = 'timeless'").collect()
    assert len(last) == 1 and last[0]["ts"] is None and last[0]["cpu_percent"] is None


@pytest.mark.parametrize("salts", [1, 3])
def test_equal_to_the_batch_join(spark, tmp_path, salts):
    rng = random.Random(salts)
    streams = Streams(spark, tmp_path)
    hosts = ["hot"] * 6 + [f"h{i}" for i in range(5)]
    made = [(rng.choice(hosts), s(rng.uniform(0, 60)), rng.random() < 0.4, i) for i in range(400)]
    # arrival is up to 8 seconds late, and up to 30 for alerts
    arrival = sorted((t + rng.uniform(0, 30 if alert else 8) * SECOND, h, t, alert, i) for h, t, alert, i in made)
    for part in (arrival[:150], arrival[150:290], arrival[290:]):
        alerts = [(h, t, f"a{i}") for _, h, t, alert, i in part if alert]
        samples = [(h, t, float(i), rng.random()) for _, h, t, alert, i in part if not alert]
        streams.add(alerts, samples, salts=salts)
    streams.add([], [("end", s(1000), 0.0, 0.0)], salts=salts)
    assert rows(streams.found()) == rows(streams.batch())


def test_a_silent_host_is_forgotten(spark, tmp_path):
    streams = Streams(spark, tmp_path)
    streams.add([], [("h", s(0), 1.0, 1.0)], idle="100 seconds", keep="1 second")
    streams.add([], [("g", s(500), 1.0, 1.0)], idle="100 seconds", keep="1 second")
    streams.add([("h", s(300), "a")], [("g", s(600), 1.0, 1.0)], idle="100 seconds", keep="1 second")
    assert [r["cpu_percent"] for r in streams.found().collect()] == [None]


def test_many_hosts_share_the_groups_of_the_state(spark, tmp_path, monkeypatch):
    """State rows follow the groups, not the hosts; every host gets its own samples, empty and odd names too."""
    jobs = []
    monkeypatch.setitem(globals(), "run_metrics_as_of", lambda *a, **b: jobs.append(as_of.run_metrics_as_of(*a, **b)) or jobs[-1])
    rng = random.Random(5)
    hosts = [None, "", '"', "a\nb", "ü", *(f"h{i}" for i in range(700))]
    streams = Streams(spark, tmp_path)
    for part in range(2):
        samples = [(h, s(100 * part + rng.uniform(0, 90)), rng.random(), None if rng.random() < 0.3 else 2.0) for h in hosts for _ in range(2)]
        streams.add([(h, s(100 * part + rng.uniform(0, 90)), f"{part}-{i}") for i, h in enumerate(hosts)], samples)
    streams.add([], [("end", s(1000), 0.0, 0.0)])
    assert rows(streams.found()) == rows(streams.batch())
    state_rows = max(o["numRowsTotal"] for job in jobs for p in job.recentProgress for o in p["stateOperators"])
    assert 0 < state_rows <= 1024 < as_of.SALTS * len(hosts)
