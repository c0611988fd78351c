"""Streams of events: sources with a fixed schema, windowed counts with a watermark, and a log
folded to current state with one small state for each key."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def json_events(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stream of the JSON lines files that appear below ``path``."""
    return spark.readStream.schema(schema).option("mode", "FAILFAST").json(path)


def counts(events: DataFrame, at: str, kind: str, width: str, late: str) -> DataFrame:
    """Events by time window and kind; events later than ``late`` are dropped by the watermark."""
    return events.withWatermark(at, late).groupBy(F.window(at, width), kind).agg(F.count("*").alias("n"))


def folded(events: DataFrame, key: str, sequence: str, event_id: str, kind: str, value: str, undoes: str, reset: str) -> DataFrame:
    """Current value of each key after each batch, by the rule of the batch operators: an event that another
    one undoes, by id, has never happened; then the last event after the last reset counts.

    State is the key's log (ids, kinds, values, undone ids), as an undone reset revives what it cleared.
    Events of one batch are taken by ``sequence``; one that is not newer than the state is ignored."""
    out = f"{key} string, current double, n_live int, last long"

    def step(name: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ids, kinds, values, gone, last = (list(x) if isinstance(x, (list, tuple)) else x for x in state.get) if state.exists else ([], [], [], [], -1)
        rows = pd.concat(list(frames)).sort_values("_s")
        for s, i, k, v, u in rows[["_s", "_i", "_k", "_v", "_u"]].itertuples(index=False):
            if s <= last:
                continue
            last = int(s)
            if u is not None:
                gone.append(str(u))
            else:
                ids.append(str(i)), kinds.append(k), values.append(float(v))
        state.update((ids, kinds, values, gone, last))
        standing = [(k, v) for i, k, v in zip(ids, kinds, values) if i not in set(gone)]
        start = max((n for n, (k, _) in enumerate(standing, 1) if k == reset), default=0)
        live = [v for _, v in standing[start:]]
        yield pd.DataFrame({key: [name[0]], "current": [live[-1] if live else None], "n_live": [len(live)], "last": [last]})

    slim = events.select(F.col(key).cast("string").alias(key), F.col(sequence).cast("long").alias("_s"), F.col(event_id).cast("string").alias("_i"), F.col(kind).alias("_k"), F.col(value).cast("double").alias("_v"), F.col(undoes).cast("string").alias("_u"))
    return slim.groupBy(key).applyInPandasWithState(step, out, "ids array<string>, kinds array<string>, live array<double>, gone array<string>, last long", "update", GroupStateTimeout.NoTimeout)
