"""Boundaries, half-open segments, and the labels they give to frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.boundaries import segment_at


def run_boundaries(frames: DataFrame) -> DataFrame:
    """(episode_index, ordinal, boundary, from_label, to_label): the frames whose label differs from the one before."""
    order = Window.partitionBy("episode_index").orderBy("frame_index")
    marked = frames.select("episode_index", F.col("frame_index").alias("boundary"), F.lag("label").over(order).alias("from_label"), F.col("label").alias("to_label"))
    found = marked.where("from_label <> to_label")
    return found.withColumn("ordinal", F.row_number().over(Window.partitionBy("episode_index").orderBy("boundary")) - 1)


def run_segments(frames: DataFrame) -> DataFrame:
    """(episode_index, segment_index, label, start_frame, end_frame): maximal runs of one label. One shuffle by episode."""
    order = Window.partitionBy("episode_index").orderBy("frame_index")
    whole = Window.partitionBy("episode_index")
    new = F.coalesce((F.lag("label").over(order) != F.col("label")).cast("int"), F.lit(0))
    marked = frames.select("episode_index", "frame_index", "label", new.alias("new"), (F.max("frame_index").over(whole) + 1).alias("length"))
    first = marked.where("new = 1 OR frame_index = 0")
    return first.select(
        "episode_index",
        (F.row_number().over(order) - 1).alias("segment_index"),
        "label",
        F.col("frame_index").alias("start_frame"),
        F.coalesce(F.lead("frame_index").over(order), "length").alias("end_frame"),
    )


def annotation_segments(annotations: DataFrame) -> DataFrame:
    """Rows (episode_index, length, start_subtask_index, boundaries) as segments with their sub-tasks."""
    edges = F.concat(F.array(F.lit(0).cast("long")), F.col("boundaries").cast("array<bigint>"))
    ends = F.concat(F.col("boundaries").cast("array<bigint>"), F.array(F.col("length").cast("long")))
    rows = annotations.select("episode_index", "start_subtask_index", F.posexplode(F.arrays_zip(edges.alias("s"), ends.alias("e"))).alias("segment_index", "z"))
    return rows.select("episode_index", "segment_index", (F.col("start_subtask_index") + F.col("segment_index")).alias("subtask_index"), F.col("z.s").alias("start_frame"), F.col("z.e").alias("end_frame"))


def with_template(segments: DataFrame, subtasks: DataFrame) -> DataFrame:
    """Segments with the skill and text of their sub-task; the template is a handful of rows by definition."""
    return segments.join(F.broadcast(subtasks), "subtask_index")


def label_frames(frames: DataFrame, annotations: DataFrame, subtasks: int) -> DataFrame:
    """frames with subtask_index, the segment that holds them.

    The interval join is an equi-join by episode with one annotation row each, whose boundaries are
    counted: no frame meets more than one row, and adaptive execution may split a long episode.
    """
    own = annotations.select("episode_index", "start_subtask_index", "boundaries")
    joined = frames.join(own, "episode_index")
    return joined.withColumn("subtask_index", segment_at("frame_index", "start_subtask_index", "boundaries", subtasks)).drop("start_subtask_index", "boundaries")


def label_by_intervals(frames: DataFrame, segments: DataFrame, block: int = 256) -> DataFrame:
    """frames with the segment_index whose start_frame <= frame_index < end_frame holds, for segments of any origin, overlapping ones too.

    Both sides are dealt to blocks of frames, so a frame meets only the segments that touch its block,
    and a long episode is as many keys as it has blocks.
    """
    own = segments.where("end_frame > start_frame").select(F.col("episode_index").alias("_e"), "segment_index", "start_frame", "end_frame")
    own = own.withColumn("_b", F.explode(F.sequence(F.floor(F.col("start_frame") / block), F.floor((F.col("end_frame") - 1) / block))))
    held = (F.col("frame_index") >= F.col("start_frame")) & (F.col("frame_index") < F.col("end_frame"))
    on = (F.col("episode_index") == F.col("_e")) & (F.floor(F.col("frame_index") / block) == F.col("_b")) & held
    return frames.join(own, on).drop("_e", "_b", "start_frame", "end_frame")


def durations(segments: DataFrame, by: str = "label") -> DataFrame:
    """Number, total and extreme lengths of segments by label."""
    n = F.col("end_frame") - F.col("start_frame")
    return segments.groupBy(by).agg(F.count("*").alias("n_segments"), F.sum(n).alias("frames"), F.min(n).alias("shortest"), F.max(n).alias("longest"))
