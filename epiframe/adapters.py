"""The driver's tables seen as episode data (the mappings A1 to A9 of the fixtures)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def conversation_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: a conversation is an episode, a turn a frame, its role the label."""
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("episode_index"), F.col("turn").alias("frame_index"), F.col("role").alias("label"))


def event_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: a user's events in time order are an episode."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return rows.select(
        F.col("user_id").alias("episode_index"),
        (F.row_number().over(order) - 1).cast("long").alias("frame_index"),
        F.col("event_type").alias("label"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        "event_id",
        "value",
    )


def item_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: an order's line items are an episode of four numeric features."""
    keys = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity"]
    values = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    order = Window.partitionBy("l_orderkey").orderBy(*keys)
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", *keys, *values[1:])
    return rows.select(F.col("l_orderkey").alias("episode_index"), (F.row_number().over(order) - 1).cast("long").alias("frame_index"), *values)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: embeddings are a vector feature, the label its camera."""
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("camera"), F.col("embedding").alias("vector"))


def payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: documents are payload files."""
    return table(spark, sf_dir, "documents").select(F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"), F.col("text"), F.col("doc_id"))


def review_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6: labels are outcomes."""
    status = F.when(F.col("toxic") == 1, "failed").when(F.col("quality") == 1, "accepted").otherwise("needs_review")
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("episode_index"), status.alias("status"))


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7: orders are episode records."""
    status = F.when(F.col("o_orderstatus") == "F", "accepted").when(F.col("o_orderstatus") == "O", "needs_review").otherwise("pending")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("episode_index"), status.alias("status"), F.col("o_orderdate").cast("timestamp").alias("updated_at"))


def item_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7: an order's length is its number of line items."""
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("episode_index")).agg(F.count("*").alias("length"))


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8: regions are tasks."""
    return table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("task_index"), F.col("r_name").alias("task"))


def cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8: nations are cameras."""
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("camera_order"), F.col("n_name").alias("camera"))


def golden_arrays(frames: DataFrame, transitions: int = 3) -> DataFrame:
    """(episode_index, length, boundaries): the first label changes of each episode, as annotations have them."""
    order = Window.partitionBy("episode_index").orderBy("frame_index")
    change = F.when(F.col("label") != F.lag("label").over(order), F.col("frame_index"))
    marked = frames.select("episode_index", "frame_index", change.alias("boundary"))
    grouped = marked.groupBy("episode_index").agg(F.count("*").alias("length"), F.sort_array(F.collect_list("boundary")).alias("all"))
    return grouped.select("episode_index", "length", F.slice("all", 1, transitions).alias("boundaries"))


def shifted_predictions(golden: DataFrame) -> DataFrame:
    """(episode_index, boundaries): a deterministic stand-in for a model: shifted golden boundaries, some short, some missing."""
    shift = F.transform("boundaries", lambda b, i: b + (F.col("episode_index") * 7 + i * 3) % 11 - 5)
    short = F.when(F.col("episode_index") % 13 == 0, F.slice(shift, 1, F.greatest(F.size("boundaries") - 1, F.lit(0)))).otherwise(shift)
    return golden.where("episode_index % 17 <> 0").select("episode_index", short.alias("boundaries"))


def statuses(golden: DataFrame) -> DataFrame:
    """(episode_index, status) by the last digit: 8 of 10 accepted, one for review, one failed."""
    d = F.col("episode_index") % 10
    return golden.select("episode_index", F.when(d < 8, "accepted").when(d == 8, "needs_review").otherwise("failed").alias("status"))
