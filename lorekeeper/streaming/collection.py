"""Collection that can be stopped and resumed: cursors, exhausted flags and totals of routes as keyed state of a stream."""

from __future__ import annotations

import time
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What a pass over a route reports. cursor grows with the passes of a route.
RESULTS = "route_id string, cursor long, processed long, accepted long, context long, duplicates long, rejected long, errors long, map_candidates long, exhausted boolean"
TOTALS = ("processed", "accepted", "context", "duplicates", "rejected", "errors", "map_candidates")
#: Accepted rows or candidates for the map in one pass that make a route productive (a fixed value).
PRODUCTIVE = 6
_TOLD = "cursor long, passes long, " + ", ".join(f"{c} long" for c in TOTALS) + ", latest_acceptance_rate double, last_accepted long, productive boolean, exhausted boolean, blocked boolean"
#: Beside what is told: the cursors that were counted, as ranges, and those of the last productive and the last exhausting pass.
_STATE = _TOLD + ", counted string, productive_at long, exhausted_at long"


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def with_cursor(counted: list[list[int]], cursor: int) -> bool:
    """Adds a cursor to sorted ranges, joining neighbours; whether it is new."""
    at = bisect_right(counted, [cursor, 1 << 62]) - 1
    if at >= 0 and cursor <= counted[at][1]:
        return False
    counted.insert(at + 1, [cursor, cursor])
    for k in (at + 1, at):
        if 0 <= k < len(counted) - 1 and counted[k][1] + 1 == counted[k + 1][0]:
            counted[k][1] = counted.pop(k + 1)[1]
    return True


def result_stream(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(RESULTS).option("maxFilesPerTrigger", files_per_batch).json(folder)


def _advance(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    names = _names(_STATE)
    start = dict.fromkeys(names, 0) | {"cursor": -1, "latest_acceptance_rate": 0.0, "productive": False, "exhausted": False, "blocked": False, "counted": "", "productive_at": -1, "exhausted_at": -1}
    now = dict(zip(names, state.get)) if state.exists else start
    counted = [[int(x) for x in part.split(":")] for part in now["counted"].split(",") if part]
    for batch in batches:
        for r in batch.to_dict("records"):
            cursor, count = int(r["cursor"]), {c: 0 if pd.isna(r[c]) else int(r[c]) for c in TOTALS}
            if not with_cursor(counted, cursor):
                continue
            now["passes"] += 1
            for c, n in count.items():
                now[c] += n
            if cursor > now["cursor"]:
                now["cursor"], now["last_accepted"] = cursor, count["accepted"]
                now["latest_acceptance_rate"] = count["accepted"] / count["processed"] if count["processed"] else 0.0
            if count["accepted"] >= PRODUCTIVE or count["map_candidates"] >= PRODUCTIVE:
                now["productive"], now["productive_at"] = True, max(now["productive_at"], cursor)
            if r["exhausted"] is True and not count["accepted"]:
                now["exhausted_at"] = max(now["exhausted_at"], cursor)
            now["blocked"] = now["blocked"] or bool(count["errors"] and not count["processed"])
    now["exhausted"] = now["exhausted_at"] >= 0 and now["exhausted_at"] >= now["productive_at"]
    now["counted"] = ",".join(f"{a}:{b}" for a, b in counted)
    state.update(tuple(now[c] for c in names))
    yield pd.DataFrame([{"route_id": key[0], **{c: now[c] for c in _names(_TOLD)}}])


def route_states(results: DataFrame) -> DataFrame:
    """The state of every route that a batch of results (RESULTS) touches: cursor, totals, and whether it is productive, exhausted or blocked.

    A pass is known by its cursor and counts once, in whatever file, batch and order it comes. A productive pass ends an earlier exhaustion; the rate and the last
    accepted rows are those of the greatest cursor. Passes without route or cursor are left out, missing counts are 0.
    """
    return results.where("route_id is not null and cursor is not null").groupBy("route_id").applyInPandasWithState(_advance, f"route_id string, {_TOLD}", _STATE, "update", "NoTimeout")


def collect(results: DataFrame, folder: str, targets: dict[str, int] | None = None) -> dict[str, int]:
    """Takes in what is there by now, batch by batch, and tells the totals over all routes; with ``targets``, stops once every one of them is met.

    The states go to a part of ``folder`` for each batch, which a batch that runs again replaces, and the checkpoint beside them resumes where the last run ended. A batch
    that has begun when the targets are met is finished and counts.
    """
    spark, met = results.sparkSession, []

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/states/batch={number}")
        if targets and all((progress(spark, folder)[c] or 0) >= n for c, n in targets.items()):
            met.append(number)

    query = route_states(results).writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    while query.isActive and not met:
        time.sleep(0.02)
    if query.isActive:
        query.stop()
    query.awaitTermination()
    return progress(spark, folder)


def latest_states(spark: SparkSession, folder: str) -> DataFrame:
    """Every route's state after the last batch that touched it."""
    states = spark.read.option("mergeSchema", False).parquet(f"{folder}/states")
    return states.groupBy("route_id").agg(F.max_by(F.struct(*_names(_TOLD)), "batch").alias("s")).select("route_id", "s.*")


def progress(spark: SparkSession, folder: str) -> dict[str, int]:
    return latest_states(spark, folder).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in TOTALS]).first().asDict()
