"""Transitions as a stream: a state machine for each episode, counts, and an exactly-once log."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..schemas import EDGES, HUMAN_EDGES

OUTPUT = "episode_index long, event_id string, status string, accepted boolean, reason string"
STATE = "status string, time timestamp"


def _machine(edges: dict, human_edges: dict):
    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        status, last = state.get if state.exists else ("pending", pd.Timestamp.min)
        last = pd.Timestamp(last) if last is not None else pd.Timestamp.min
        rows = pd.concat(list(batches)).sort_values(["timestamp", "event_id"], kind="stable")
        out = []
        for r in rows.itertuples(index=False):
            if r.timestamp <= last:
                reason = "late"
            elif r.from_status != status:
                reason = "broken_chain"
            elif r.to_status not in edges.get(status, ()) and not (r.human and r.to_status in human_edges.get(status, ())):
                reason = "illegal_edge"
            else:
                reason, status, last = None, r.to_status, r.timestamp
            out.append((key[0], r.event_id, status, reason is None, reason))
        state.update((status, last.to_pydatetime()))
        yield pd.DataFrame(out, columns=["episode_index", "event_id", "status", "accepted", "reason"])

    return fold


def run_state_machine(events: DataFrame) -> DataFrame:
    """A stream of (event_id, episode_index, from_status, to_status, timestamp, human), judged by each episode's state.

    Late, unlinked and illegal events leave the state as it is and are put out with a reason. Events
    of one micro-batch are ordered first; a hot episode's state is one status and one time.
    """
    rows = events.select("episode_index", "event_id", "from_status", "to_status", F.col("timestamp").cast("timestamp").alias("timestamp"), "human")
    return rows.groupBy("episode_index").applyInPandasWithState(_machine(EDGES, HUMAN_EDGES), OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout)


def status_counts(events: DataFrame) -> DataFrame:
    """Online counts by status, for update or complete mode."""
    return events.groupBy("to_status").agg(F.count("*").alias("n"))


def window_counts(events: DataFrame, size: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Events by time window and kind; late ones beyond the watermark are left out."""
    w = F.window("timestamp", size, slide) if slide else F.window("timestamp", size)
    return events.withWatermark("timestamp", late).groupBy(w.alias("w"), "label").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "label", "n")


def session_counts(events: DataFrame, gap: str, late: str = "10 minutes") -> DataFrame:
    w = F.session_window("timestamp", gap)
    return events.withWatermark("timestamp", late).groupBy(w.alias("w"), "episode_index").agg(F.count("*").alias("n")).select("episode_index", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def log_writer(path: str):
    """A foreachBatch function that appends a batch's events to a table once, whatever is replayed.

    Each batch is a folder of its own number, overwritten if the batch comes again, and dealt to the
    days of its events. An event comes back with its own time, so those that an earlier batch has are
    looked for in the batch's days alone.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates(["event_id"]).withColumn("day", F.to_date("timestamp")).persist()
        days = [r.day for r in new.where("day IS NOT NULL").select("day").distinct().collect()]  # a batch's days
        try:
            old = spark.read.schema("event_id string, batch long, day date").option("basePath", path).parquet(path)
            known = old.where((F.col("batch") < number) & (F.col("day").isNull() | F.col("day").isin(days))).select("event_id")
            kept = new.join(known, "event_id", "left_anti")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":  # there is no table before the first batch
                raise
            kept = new
        kept.write.mode("overwrite").partitionBy("day").parquet(f"{path}/batch={number}")
        new.unpersist()

    return write


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The log's events with their batch and day."""
    return spark.read.schema(f"{schema}, batch long, day date").option("basePath", path).parquet(path)


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """All that the stream's source has now, written to a table: appended, or in complete mode the last state."""
    rows = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        q = rows.format("parquet").outputMode(mode).start(path)
    else:
        q = rows.outputMode(mode).foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(path)).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def run_available(stream: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """All that the stream's source has now, through a memory table."""
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.table(name)
