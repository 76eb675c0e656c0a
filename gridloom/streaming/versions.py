"""Versions of fetched documents as the state of a stream.

A URL's state has one entry for each (item, content hash) that was seen: first and last time, number of times, and
whether another hash of the URL was known when it first came. A micro-batch changes the state in the order of the times it
holds, so two new hashes in one batch see each other. What comes out are the entries that a batch has changed, to be
merged into a table by key (``sources.keyed_table``).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gridloom.functions.text import stable_id
from gridloom.sources.keyed_table import KeyedTable

#: The state is JSON text: a list of [item, hash, first time, last time, times seen, material].
_STATE = "known string"
_OUT = "canonical_url string, item_id string, content_hash string, first_us bigint, last_us bigint, times_seen bigint, is_material_change boolean"


def _seen(frames: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """The batch's sightings by item and hash, in the order of their first times."""
    rows = pd.concat(list(frames))
    grouped = rows.groupby(["item_id", "content_hash"], dropna=False, sort=False)["us"].agg(["min", "max", "size"]).reset_index()
    return grouped.sort_values(["min", "item_id", "content_hash"])


def _step(keep_ms: int | None):
    def step(key: tuple[Any, ...], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        known: dict[tuple, list] = {}
        if state.exists:
            known = {(item, content): entry for item, content, *entry in json.loads(state.get[0])}
        changed = {}
        for item, content, first, last, n in _seen(frames).itertuples(index=False):
            entry = known.get((item, content))
            if entry is None:
                other = any(h != content for _, h in known)
                entry = known[item, content] = [int(first), int(last), 0, other]
            entry[0], entry[1], entry[2] = min(entry[0], int(first)), max(entry[1], int(last)), entry[2] + int(n)
            changed[item, content] = entry
        state.update((json.dumps([(*k, *v) for k, v in known.items()]),))
        if keep_ms is not None:
            state.setTimeoutDuration(keep_ms)
        rows = [(key[0], *k, *v) for k, v in changed.items()]
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in _OUT.split(", ")])

    return step


def version_changes(fetched: DataFrame, time: str = "retrieved_at", keep_ms: int | None = None) -> DataFrame:
    """Changed versions of a stream of fetched(canonical_url, item_id, content_hash, time): version_id, the three, first
    and last time seen, times seen and is_material_change. With ``keep_ms`` a URL that nothing came for as long is forgotten."""
    kinds = {c: F.col(c).cast("string") for c in ("canonical_url", "item_id", "content_hash")}
    rows = fetched.select(*[c.alias(n) for n, c in kinds.items()], F.unix_micros(F.col(time).cast("timestamp")).alias("us")).where("canonical_url IS NOT NULL AND item_id IS NOT NULL AND content_hash IS NOT NULL AND us IS NOT NULL")
    timeout = GroupStateTimeout.NoTimeout if keep_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    out = rows.groupBy("canonical_url").applyInPandasWithState(_step(keep_ms), _OUT, _STATE, "update", timeout)
    version = stable_id(F.col("item_id"), F.col("content_hash"), prefix="DOCVER", clean=False)
    return out.select(
        version.alias("version_id"), "canonical_url", "item_id", "content_hash", F.timestamp_micros("first_us").alias("first_seen_at"), F.timestamp_micros("last_us").alias("last_seen_at"),
        "times_seen", "is_material_change",
    )


def versions_table(spark: SparkSession, path: str, buckets: int = 32) -> KeyedTable:
    return KeyedTable(spark, path, ["canonical_url", "version_id"], "times_seen", buckets)


def keep_versions(fetched: DataFrame, path: str, checkpoint: str, time: str = "retrieved_at", keep_ms: int | None = None) -> StreamingQuery:
    """Keep the table of versions at ``path`` up to date with all there is of the stream. A stopped run goes on where its
    checkpoint is; a micro-batch that is replayed changes nothing."""
    table = versions_table(fetched.sparkSession, path)
    changes = version_changes(fetched, time, keep_ms)

    def merge(batch: DataFrame, epoch: int) -> None:
        table.merge(batch, epoch, writer=checkpoint)

    return changes.writeStream.foreachBatch(merge).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
