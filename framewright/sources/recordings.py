"""Reading recordings: wide tables, long logs and camera tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.functions import images, names, times, vectors
from framewright.operators.align import ORDINAL, SEGMENT, TIME
from framewright.operators.scans import number_all
from framewright.session import stage
from framewright.sources.mixed import READ_ERRORS, is_conflict, read_mixed


def read_recordings(spark: SparkSession, path: str, *, segment: str = SEGMENT, merge: bool = True) -> DataFrame:
    """A folder of recordings as Parquet, with the columns of all files; a column that a file lacks is null there.

    Folders named ``column=value`` give that column as text, and a filter on it skips folders. Other
    folders are searched too. Without a segment column each file is one segment, named after its path
    below ``path`` without the ending. Nanosecond columns are read as integers. A missing folder raises.
    ``merge=False`` takes the columns of one file, which saves a look at every file's footer. A column
    of different types in different files takes the least type that holds them, see `read_mixed`.
    """
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    reader = spark.read.option("mergeSchema", str(merge).lower())
    try:
        whole = reader.option("recursiveFileLookup", "true").parquet(path)
    except READ_ERRORS as e:
        if not is_conflict(e):
            raise
        return read_mixed(spark, path, {segment: _path_below(path)})
    named = _by_folders(spark, path, merge, whole.columns)
    rows = whole if named is None else named
    if segment not in rows.columns:
        rows = rows.withColumn(segment, _path_below(path))
    return rows


def _by_folders(spark: SparkSession, path: str, merge: bool, plain: Sequence[str]) -> DataFrame | None:
    """The table with the columns that its folders name, if they name any."""
    infer = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(infer)
    spark.conf.set(infer, "false")  # else a segment 007 would become 7
    try:
        rows = spark.read.option("mergeSchema", str(merge).lower()).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None  # files only in plain folders
    finally:
        spark.conf.set(infer, before)
    return rows if set(rows.columns) - set(plain) else None


def _path_below(path: str) -> Column:
    """The path of a row's file below ``path``, or the file's name where ``path`` is a file or a pattern."""
    root = "/" + re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "", path).strip("/") + "/"
    # the name is percent-encoded; a plus sign in it is meant
    file = F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B"))
    at = F.instr(file, root)
    name = F.when(at > 0, F.substring(file, at + len(root), F.length(file))).otherwise(F.substring_index(file, "/", -1))
    return F.regexp_replace(name, r"\.parquet$", "")


def read_catalog(spark: SparkSession, name: str) -> DataFrame:
    """A recording table by its catalog name."""
    return spark.table(name)


def union_recordings(recordings: Sequence[DataFrame]) -> DataFrame:
    """Several recordings as one; a column that one of them lacks is null there."""
    whole = recordings[0]
    for other in recordings[1:]:
        whole = whole.unionByName(other, allowMissingColumns=True)
    return whole


def on_timeline(recording: DataFrame, index: str) -> DataFrame:
    """The recording keyed by one of its timelines; rows without that time are left out."""
    at = times.normalize_times(recording, index)
    return recording.withColumn(TIME, at).where(F.col(TIME).isNotNull())


def filter_segments(recording: DataFrame, segments: Sequence[str] | DataFrame) -> DataFrame:
    """Rows of some segments; a long list is given as a table."""
    if isinstance(segments, DataFrame):
        return recording.join(segments.select(SEGMENT), [SEGMENT], "left_semi")
    return recording.where(F.col(SEGMENT).isin(*segments))


def filter_contents(log: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Rows of a long log that belong to some entities."""
    return log.where(F.col("entity_path").isin(*paths))


def select_contents(recording: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Columns of a wide recording that belong to some entities, with its timelines."""
    kept = [c for c in recording.columns if ":" not in c or c.split(":")[0] in paths]
    return recording.select(*[F.col(f"`{c}`") for c in kept])


def project_scalars(recording: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns once each, in the given order."""
    return recording.select(*[F.col(f"`{c}`") for c in dict.fromkeys(columns)])


def pivot_log(log: DataFrame, columns: Sequence[str], *, text: Sequence[str] = ()) -> DataFrame:
    """The wide layout of a long log.

    ``columns`` names the numeric and ``text`` the text columns, so no job is needed to
    find them. A row of the log keeps its ordinal: rows are not merged, and without a
    merge nothing has to be shuffled.
    """
    name = F.concat_ws(":", "entity_path", "component", "field")
    wide = [F.when(name == c, F.col("value")).alias(c) for c in columns]
    words = [F.when(name == c, F.array(F.col("text"))).alias(c) for c in text]
    return log.select(SEGMENT, ORDINAL, TIME, *wide, *words)


def merge_instants(recording: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows logged at one time as a single row: the last value of each column at that time."""
    merged = [F.max_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), F.col(ORDINAL))).alias(c) for c in columns]
    return recording.groupBy(SEGMENT, TIME).agg(F.max(ORDINAL).alias(ORDINAL), *merged)


def unpivot_recording(recording: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The long form of the numeric columns of a wide recording."""
    cells = [F.struct(F.lit(c).alias("name"), vectors.flatten_all(F.col(f"`{c}`"), recording.schema[c].dataType).cast("array<float>").alias("value")) for c in columns]
    present = F.filter(F.array(*cells), lambda cell: cell["value"].isNotNull())
    long = recording.select(SEGMENT, ORDINAL, TIME, F.explode(present).alias("_cell"))
    parts = names.column_parts(F.col("_cell.name"))
    return long.select(SEGMENT, ORDINAL, TIME, parts.alias("_p"), F.col("_cell.value").alias("value")).select(
        SEGMENT, ORDINAL, TIME, "_p.entity_path", "_p.component", "_p.field", "value"
    )


def camera_reader(recording: DataFrame, path: str, key: str, index: str) -> DataFrame:
    """Rows of one camera of a wide recording on its own timeline: bytes, and the format of raw frames."""
    present = [c for c in names.SAMPLE_SUFFIX.values() if path + c in recording.columns]
    if not present:
        raise ValueError(f"no supported frames at {path!r}")
    column = path + present[0]
    sample = images.blob_to_bytes(F.col(f"`{column}`"), recording.schema[column].dataType)
    fmt = f"{path}:Image:format"
    shape: Column = F.lit(None).cast("struct<width:int,height:int>")
    if fmt in recording.columns:
        whole = F.col(f"`{fmt}`")
        one = F.get(whole, F.lit(0)) if recording.schema[fmt].dataType.typeName() == "array" else whole
        shape = F.when(
            one.isNotNull(), F.struct(one["width"].cast("int").alias("width"), one["height"].cast("int").alias("height"))
        )
    rows = recording.select(
        SEGMENT,
        F.lit(key).alias("camera_key"),
        ORDINAL,
        times.normalize_times(recording, index).alias(TIME),
        sample.alias("sample"),
        shape.alias("format"),
    )
    return rows.where(F.col("sample").isNotNull() & F.col(TIME).isNotNull())


def camera_index(recording: DataFrame, cameras: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``segment_id, camera_key, ordinal, time_ns, size_bytes``: one row per frame of several cameras.

    ``cameras`` are (path, key, index). All are read in one pass, and nothing but the length is
    taken of a blob: rows without a frame go before anything is converted.
    """
    held = []
    for path, key, index in cameras:
        present = [path + c for c in names.SAMPLE_SUFFIX.values() if path + c in recording.columns]
        if not present:
            raise ValueError(f"no supported frames at {path!r}")
        size = images.blob_length(F.col(f"`{present[0]}`"), recording.schema[present[0]].dataType)
        time = times.normalize_times(recording, index)
        cell = F.struct(F.lit(key).alias("camera_key"), time.alias(TIME), size.alias("size_bytes"))
        held.append(F.when(size.isNotNull() & time.isNotNull(), cell))
    return recording.select(SEGMENT, ORDINAL, F.explode(F.array_compact(F.array(*held))).alias("_c")).select(
        SEGMENT, "_c.camera_key", ORDINAL, f"_c.{TIME}", "_c.size_bytes"
    )


def segment_sizes(table: DataFrame, *, segment: str = SEGMENT, size: str = "size_bytes") -> DataFrame:
    """Bytes of every segment; an unknown size counts as 0."""
    return table.groupBy(F.col(segment).alias(SEGMENT)).agg(F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("size_bytes"))


def stored_sizes(recording: DataFrame, *, segment: str = SEGMENT) -> DataFrame:
    """``segment_id, rows, size_bytes``: bytes of the files that hold a segment, as the file listing gives them.

    No column but the segment's is read, and none where files or folders name it. A file that holds
    several segments counts for each by its share of the rows, rounded down, so every segment with
    rows has a size. Segments without rows are not found. ``recording`` must come straight from files.
    """
    file, size = F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_size")
    rows = recording.select(F.col(f"`{segment}`").alias(SEGMENT), file, size)
    held = rows.groupBy(SEGMENT, "_file").agg(F.count(F.lit(1)).alias("rows"), F.first("_size").alias("_size"))
    # one row per file and segment is left here
    files = held.groupBy("_file").agg(F.sum("rows").alias("_all"))
    share = F.expr("cast(cast(_size as decimal(20)) * rows div _all as bigint)")
    return held.join(files, ["_file"]).groupBy(SEGMENT).agg(F.sum("rows").alias("rows"), F.sum(share).alias("size_bytes"))


def stored_ranges(spark: SparkSession, path: str, index: str, *, segment: str = SEGMENT) -> DataFrame:
    """``segment_id, min_ns, max_ns, rows`` of a timeline from the files' footers, without reading rows.

    For recordings whose folders name the segment (``segment_id=…``) and whose timeline is stored as
    whole nanoseconds. ``rows`` are those with a time; a segment without any has null bounds. A file
    without any time, or without statistics, has no bounds in its footer: then the one column is read.
    The result is written to the scratch folder, one row per segment.
    """
    keys = ("spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown", "spark.sql.sources.partitionColumnTypeInference.enabled")
    before = {key: spark.conf.get(key) for key in keys}
    footers = ",".join(s for s in before[keys[0]].split(",") if s != "parquet")  # the newer reader alone asks footers
    try:
        for key, value in zip(keys, (footers, "true", "false")):
            spark.conf.set(key, value)
        try:
            return stage(range_rows(spark.read.parquet(path), index, segment), "ranges")
        except READ_ERRORS as e:
            if "No min/max found" not in str(e):
                raise
        for key in keys[:2]:
            spark.conf.set(key, before[key])
        return stage(range_rows(spark.read.parquet(path), index, segment), "ranges")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def range_rows(stored: DataFrame, index: str, segment: str) -> DataFrame:
    if segment not in stored.columns or stored.schema[index].dataType.typeName() != "long":
        raise ValueError(f"ranges need folders named by {segment!r} and whole nanoseconds in {index!r}")
    at = F.col(f"`{index}`")
    return stored.groupBy(F.col(f"`{segment}`").alias(SEGMENT)).agg(F.min(at).alias("min_ns"), F.max(at).alias("max_ns"), F.count(at).alias("rows"))


def place_segments(spark: SparkSession, segments: Sequence[str]) -> DataFrame:
    """A given list of segments with their places."""
    rows = [(s, i) for i, s in enumerate(dict.fromkeys(segments))]
    return spark.createDataFrame(rows, f"{SEGMENT} string, seg_pos long")


def segment_listing(
    recording: DataFrame, *, segments: Sequence[str] | None = None, max_segments: int | None = None
) -> DataFrame:
    """Segments to work on with their place: all in name order, or the given ones in the given order."""
    held = recording.select(SEGMENT).distinct()
    if segments:
        listed = place_segments(recording.sparkSession, segments).join(held, [SEGMENT], "left_semi")
    else:
        listed = number_all(held, [SEGMENT], "seg_pos")
    # Places are dense over the whole list, so the first n need no sort.
    return listed if max_segments is None else listed.where(F.col("seg_pos") < max_segments)


def count_segments(recording: DataFrame) -> DataFrame:
    return recording.agg(F.count_distinct(SEGMENT).alias("num_segments"))


def skip_empty_segments(recording: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows of the segments that are not known to be empty."""
    empty = sizes.where(F.col("size_bytes") == 0).select(SEGMENT)
    return recording.join(empty, [SEGMENT], "left_anti")
