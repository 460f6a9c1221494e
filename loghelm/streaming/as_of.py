"""As-of join of two streams: alerts and the metric samples of their hosts."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

DELAY = "10 minutes"
KEEP = "1 hour"
IDLE = "7 days"
SALTS = 4
#: Groups that hosts are hashed to; a group's hosts are worked on side by side.
GROUPS = 256
#: Waiting alerts and known samples of a group's hosts, each as an Arrow stream.
STATE_SCHEMA = "waiting BINARY, samples BINARY"
SAMPLE, ALERT, TIMELESS = 0, 1, 2
_MICROS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def streamed_metrics_as_of(
    alerts: DataFrame,
    metrics: DataFrame,
    key: str = "host",
    ts: str = "ts",
    values: tuple[str, ...] = ("cpu_percent", "memory_percent"),
    delay: str = DELAY,
    keep: str = KEEP,
    idle: str = IDLE,
    salts: int = SALTS,
    groups: int = GROUPS,
) -> DataFrame:
    """Add to a stream of alerts the latest sample of the same host not younger than the alert,
    out of a stream of samples; the rows of `metrics_as_of`, each once.

    An alert waits until the watermark of the samples (the newest of any host less `delay`) has reached
    its time, since until then a better sample may come; a timer of the engine wakes its host if nothing arrives
    for it. Samples that are older than the watermark on arrival are dropped by the engine, alerts never are:
    one that comes late is answered at once from the samples held, which reach back `keep` behind the
    watermark, and always to one sample before that. Of several samples at one instant the greatest counts.
    An alert without a time gets no sample; samples without a time are left out.

    State is kept per group of hosts, by a hash, and salt: many small hosts cost one call a batch, and a host
    with a large share of the alerts is spread over `salts` tasks, each with that host's samples. A host with
    nothing waiting is forgotten when the watermark is `idle` past its newest sample. `values` are DOUBLE.
    `salts` and `groups` must stay the same for a checkpoint.
    """
    own = [c for c in alerts.columns if c not in (key, ts)]
    own_json = F.to_json(F.struct(*own), _MICROS) if own else F.lit("{}")
    number = F.col(ts).cast("timestamp")
    left = alerts.select(
        F.col(key).alias("key"),
        F.pmod(F.xxhash64(own_json, ts), F.lit(salts)).cast("int").alias("salt"),
        F.when(F.col(ts).isNull(), TIMELESS).otherwise(ALERT).alias("kind"),
        F.coalesce(F.unix_micros(number), F.lit(0)).alias("at"),
        own_json.alias("own"),
        *[F.lit(None).cast("double").alias(f"v{i}") for i in range(len(values))],
        F.lit(None).cast("timestamp").alias("event_time"),
    )
    right = metrics.where(F.col(ts).isNotNull()).select(
        F.col(key).alias("key"),
        F.lit(-1).alias("salt"),
        F.lit(SAMPLE).alias("kind"),
        F.unix_micros(number).alias("at"),
        F.lit(None).cast("string").alias("own"),
        *[F.col(v).cast("double").alias(f"v{i}") for i, v in enumerate(values)],
        number.alias("event_time"),
    )
    # the host as text keeps its exact value in a frame with missing ones
    both = left.unionByName(right).withColumn("key", F.to_json(F.struct(F.col("key").alias(key)), _MICROS))
    both = both.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int"))
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    both = both.withColumn("salt", F.explode(F.when(F.col("kind") == SAMPLE, every).otherwise(F.array("salt"))))
    both = both.withWatermark("event_time", delay)
    answered = both.groupBy("group", "salt").applyInPandasWithState(
        _advance([f"v{i}" for i in range(len(values))], _micros(keep), _micros(idle)),
        f"key STRING, kind INT, at BIGINT, own STRING{''.join(f', v{i} DOUBLE' for i in range(len(values)))}",
        STATE_SCHEMA,
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    fields = ", ".join(f"`{c}` {alerts.schema[c].dataType.simpleString()}" for c in own)
    held = F.from_json("own", fields, _MICROS) if own else F.struct()
    host = F.from_json("key", f"`{key}` {alerts.schema[key].dataType.simpleString()}", _MICROS)
    dated = F.when(F.col("kind") == ALERT, F.timestamp_micros("at"))
    return answered.select(
        host[key].alias(key),
        dated.cast(alerts.schema[ts].dataType).alias(ts),
        *[held[c].alias(c) for c in own],
        *[F.col(f"v{i}").alias(v) for i, v in enumerate(values)],
    )


def run_metrics_as_of(
    alerts: DataFrame, metrics: DataFrame, out_path: str, checkpoint_path: str, trigger: dict | None = None, **settings
) -> StreamingQuery:
    """Start the join; answered alerts go to `out_path` exactly once. Alerts that still wait when a run ends
    are in the state and are answered by a later run."""
    found = streamed_metrics_as_of(alerts, metrics, **settings)
    writer = found.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint_path)
    return writer.outputMode("append").trigger(**(trigger or {"availableNow": True})).start()


def _micros(span: str) -> int:
    return int(pd.Timedelta(span).total_seconds() * 1_000_000)


def _advance(values: list[str], keep: int, idle: int):
    def advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        reached = state.getCurrentWatermarkMs() * 1000
        waiting, samples = ([_opened(part)] for part in state.get) if state.exists else ([], [])
        if not state.hasTimedOut:
            for rows in frames:
                timeless = rows[rows["kind"] == TIMELESS]
                if len(timeless):
                    yield timeless[["key", "kind", "at", "own", *values]]
                waiting.append(rows.loc[rows["kind"] == ALERT, ["key", "at", "own"]])
                samples.append(rows.loc[rows["kind"] == SAMPLE, ["key", "at", *values]])
        waiting = pd.concat(waiting, ignore_index=True)
        samples = _in_order(pd.concat(samples, ignore_index=True), values)
        ready = waiting["at"].to_numpy() <= reached
        if ready.any():
            yield _answered(waiting[ready], samples, values)
        waiting = waiting[~ready]

        # of each host the samples from the last one before the kept time on
        host, at = samples["key"].to_numpy(), samples["at"].to_numpy()
        newest = np.append(host[1:] != host[:-1], True)[: len(host)]
        later = np.append(at[1:], 0)[: len(at)]
        samples = samples[newest | (later > reached - keep)]
        # hosts to forget, and the next time at which there is something to do
        ends = samples.groupby("key")["at"].max() + idle
        busy = ends.index.isin(waiting["key"])
        samples = samples[~samples["key"].isin(ends.index[~busy & (ends <= reached)])]
        wakes = [*ends[~busy & (ends > reached)], *waiting["at"]]
        if wakes:
            state.update((_packed(waiting), _packed(samples)))
            state.setTimeoutTimestamp(math.ceil(min(wakes) / 1000))
        elif state.exists:
            state.remove()

    return advance


def _packed(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _opened(part: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(part).read_pandas()


def _in_order(samples: pd.DataFrame, values: list[str]) -> pd.DataFrame:
    """One sample per host and instant, the greatest (no value is less than any), by host and time."""
    placed = samples.sort_values(["key", "at", *values], na_position="first", kind="stable")
    return placed.drop_duplicates(["key", "at"], keep="last", ignore_index=True)


def _answered(alerts: pd.DataFrame, samples: pd.DataFrame, values: list[str]) -> pd.DataFrame:
    """Alerts with the latest sample of their host that is not younger."""
    found = pd.merge_asof(alerts.sort_values("at"), samples.sort_values("at"), on="at", by="key")
    return found.assign(kind=ALERT)[["key", "kind", "at", "own", *values]]
