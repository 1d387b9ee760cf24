"""Cameras: what they hold, which frame belongs to which row, and which packets to copy."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.functions import images, names, rules
from framewright.functions.video import stream_size
from framewright.operators.align import ORDINAL, SEGMENT, TIME, latest_at_frames, rebase
from framewright.operators.scans import ROWS_PER_CHUNK, number_rows, plan_chunks
from framewright.session import stage

CAMERA = "camera_key"


def camera_kinds(specs: DataFrame, columns: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Kind of every camera, from the names of the columns its entity has.

    ``specs`` holds ``camera_key`` and ``path``, ``columns`` one row per column name; both
    may carry further ``keys`` such as a dataset name.
    """
    suffix = F.col("_component")
    held = columns.select(
        *keys,
        names.entity_path(F.col("name")).alias("path"),
        F.concat(F.lit(":"), F.substring_index("name", ":", -2)).alias("_component"),
    )
    held = held.where(suffix.isin(*names.SAMPLE_SUFFIX.values()))
    flags = held.groupBy(*keys, "path").agg(
        *[F.bool_or(suffix == end).alias(f"_{kind}") for kind, end in names.SAMPLE_SUFFIX.items()]
    )
    kind = rules.detect_camera_kind(F.col("_video"), F.col("_encoded_image"), F.col("_raw_image"))
    found = specs.join(flags, [*keys, "path"], "left").withColumn("kind", kind)
    error = F.when(F.col("kind").isNull(), F.lit("no supported frames at this path"))
    return found.withColumn("error", error).drop(*[f"_{k}" for k in names.SAMPLE_SUFFIX])


def camera_index(cameras: DataFrame) -> DataFrame:
    """The frames of a camera table without their bytes, but with their number of bytes."""
    held = cameras.where(F.col("sample").isNotNull())
    return held.select(SEGMENT, CAMERA, ORDINAL, TIME, F.octet_length("sample").cast("long").alias("size_bytes"))


def _frames(cameras: DataFrame) -> DataFrame:
    """Frames by place and time, of a camera table or of its index."""
    held = cameras.where(F.col("sample").isNotNull()) if "sample" in cameras.columns else cameras
    return held.select(SEGMENT, CAMERA, ORDINAL, TIME)


def first_samples(cameras: DataFrame, keys: Sequence[str] = (SEGMENT, CAMERA), index: DataFrame | None = None) -> DataFrame:
    """First stored sample of each camera; with the ``index`` only the bytes of these are looked at."""
    known = cameras.where(F.col("sample").isNotNull()) if index is None else index
    first = known.groupBy(*keys).agg(F.min(ORDINAL).alias(ORDINAL))
    return cameras.join(first, [*keys, ORDINAL], "left_semi")


def resolve_cameras(kinds: DataFrame, samples: DataFrame, requested: str | None, keys: Sequence[str] = (CAMERA,)) -> DataFrame:
    """Source codec, output format and storage of every camera.

    ``kinds`` comes from :func:`camera_kinds` (with ``video_format`` when declared),
    ``samples`` holds one first sample per camera.
    """
    declared = F.col("video_format") if "video_format" in kinds.columns else F.lit(None).cast("string")
    rows = kinds.join(samples.select(*keys, "sample"), list(keys), "left")
    codec = F.when(F.col("kind") == "video", images.video_codec_probe(F.col("sample"), declared)).when(
        F.col("kind") == "encoded_image", images.image_codec(F.col("sample"))
    )
    rows = rows.withColumn("source_codec", codec).drop("sample")
    wanted = rules.validate_output_format(F.lit(requested).cast("string"))
    fmt = rules.resolve_output_format(F.col("kind"), F.col("source_codec"), wanted["format"])
    rows = rows.withColumn("output_format", fmt)
    return rows.select(
        "*",
        names.camera_feature_key(F.col(CAMERA)).alias("feature_key"),
        rules.feature_dtype(F.col("output_format")).alias("feature_dtype"),
        rules.can_copy(F.col("kind"), F.col("source_codec"), F.col("output_format")).alias("can_copy"),
        names.sample_column(F.col("kind"), F.col("path")).alias("sample_column"),
    )


def camera_align(
    targets: DataFrame,
    cameras: DataFrame,
    camera_keys: Sequence[str],
    *,
    elapsed: Sequence[str] = (),
    video: Sequence[str] = (),
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """The frame of every camera for every output row.

    ``targets`` holds segment_id, ordinal, time_ns and frame_index of the output rows.
    Cameras in ``elapsed`` live on another timeline: their rows and the output rows are
    both counted from their own start, which for ``video`` cameras is the first stored
    packet and for images the earliest one. Only ordinals are matched; no bytes move, and
    with a camera index for ``cameras`` none are read.
    """
    frames = _frames(cameras)
    wanted = targets.select(SEGMENT, ORDINAL, TIME, "frame_index")

    def ask(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        return rows.withColumn(CAMERA, F.explode(F.array(*[F.lit(k) for k in keys])))

    same = [k for k in camera_keys if k not in elapsed]
    parts = []
    if same:
        parts.append((ask(wanted, same), frames.where(F.col(CAMERA).isin(same))))
    moved = [k for k in camera_keys if k in elapsed]
    if moved:
        packets = [k for k in moved if k in video]
        stills = [k for k in moved if k not in video]
        sides = []
        if packets:
            sides.append(rebase(frames.where(F.col(CAMERA).isin(packets)), [SEGMENT, CAMERA], by_stored_order=True))
        if stills:
            sides.append(rebase(frames.where(F.col(CAMERA).isin(stills)), [SEGMENT, CAMERA]))
        shown = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
        parts.append((ask(rebase(wanted, [SEGMENT]), moved), shown))
    asked, shown = parts[0]
    if len(parts) == 2:
        asked, shown = asked.unionByName(parts[1][0]), shown.unionByName(parts[1][1])
    # Moving times does not change how many rows a camera has.
    keys = ask(wanted.select(SEGMENT), camera_keys).unionByName(frames.select(SEGMENT, CAMERA))
    return latest_at_frames(asked, shown, [SEGMENT, CAMERA], counted=keys, rows_per_chunk=rows_per_chunk)


def used_frames(aligned: DataFrame) -> DataFrame:
    """``segment_id, camera_key, bucket, bits``: a bit for each frame that some output row uses.

    A row stands for 32,768 ordinals of a camera and has at most 4 KB; it ends with its last bit.
    """
    used = aligned.where(F.col("frame_ordinal").isNotNull())
    place = F.bitmap_bit_position(F.col("frame_ordinal"))
    bits = used.groupBy(SEGMENT, CAMERA, F.bitmap_bucket_number(F.col("frame_ordinal")).alias("bucket"))
    found = bits.agg(F.bitmap_construct_agg(place).alias("bits"), F.max(place).alias("_last"))
    length = F.call_function("div", F.col("_last"), F.lit(8)).cast("int") + 1
    return found.select(SEGMENT, CAMERA, "bucket", F.substring("bits", F.lit(1), length).alias("bits"))


def frame_pick(aligned: DataFrame, cameras: DataFrame, *, most_bytes: int = 64 << 20) -> DataFrame:
    """Camera rows that at least one output row uses, each once, with their bytes.

    The rows in use are written as bitmaps. These go to the camera rows, so that bytes nobody
    uses are dropped where they are read: at once up to ``most_bytes`` of bitmaps, else in as
    many passes over the cameras as it takes, each with its share of the bitmaps.
    """
    marked = stage(used_frames(aligned), "used-frames")
    held = marked.agg(F.coalesce(F.sum(F.octet_length("bits") + 64), F.lit(0))).first()[0]
    passes = max(1, -(-int(held) // most_bytes))
    place = F.bitmap_bit_position(F.col(ORDINAL))
    byte = F.hex(F.substring("bits", F.call_function("div", place, F.lit(8)).cast("int") + 1, F.lit(1)))
    bit = F.call_function("shiftright", F.conv(byte, 16, 10).try_cast("int"), F.pmod(place, F.lit(8)).cast("int"))
    keys = [SEGMENT, CAMERA, "bucket"]
    rows = cameras.withColumn("bucket", F.bitmap_bucket_number(F.col(ORDINAL)))
    found = []
    for turn in range(passes):
        own = marked.where(F.pmod(F.xxhash64(*keys), F.lit(passes)) == turn)
        found.append(rows.join(F.broadcast(own), keys).where(bit.bitwiseAND(F.lit(1)) == 1).select(*cameras.columns))
    return reduce(DataFrame.unionByName, found)


def packet_manifest(cameras: DataFrame, *, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Packets of every camera in stored order, with times counted from the first packet.

    ``cameras`` may be a camera index; the order and the times are worked out without the bytes.
    """
    keys = [SEGMENT, CAMERA]
    packets = _frames(cameras)
    chunks = plan_chunks(packets, keys, [ORDINAL], rows_per_chunk=rows_per_chunk)
    numbered = number_rows(packets, "packet_index", chunks)
    return rebase(numbered, keys, by_stored_order=True).withColumnRenamed(TIME, "pts_ns")


def copied_packets(cameras: DataFrame, copied: DataFrame) -> DataFrame:
    """Packets of the cameras in ``copied`` with their bytes, times counted from the first packet.

    The start of a camera is one row, so while these rows can be broadcast the bytes are
    written where they are read. Within a file packets stand in stored order.
    """
    keys = [SEGMENT, CAMERA]
    packets = cameras.where(F.col("sample").isNotNull())
    starts = packets.groupBy(*keys).agg(F.min_by(TIME, ORDINAL).alias("_start"))
    placed = stage(copied.join(starts, keys), "packet-starts")
    rows = packets.select(*keys, ORDINAL, TIME, "sample").join(placed, keys)
    rows = rows.withColumn("pts_ns", F.col(TIME) - F.col("_start")).drop(TIME, "_start")
    return rows.sortWithinPartitions(*keys, ORDINAL)


def decode_raw(cameras: DataFrame) -> DataFrame:
    """Raw camera rows as RGB frames, with the reason where a buffer cannot be read.

    ``format`` is a struct of width and height. Rows are independent: no shuffle.
    """
    width, height = F.col("format.width"), F.col("format.height")
    checked = cameras.withColumn("_raw", images.raw_channels(F.col("sample"), width, height))
    rgb = images.raw_to_rgb(F.col("sample"), width, height, F.col("_raw.color_model"))
    frame = F.when(F.col("_raw.error").isNull(), images.rgb_frame(rgb, width, height))
    return checked.select(SEGMENT, CAMERA, ORDINAL, TIME, F.col("_raw.channels").alias("channels"), frame.alias("image"), F.col("_raw.error").alias("error"))


def camera_features(resolved: DataFrame, samples: DataFrame, keys: Sequence[str] = (CAMERA,)) -> DataFrame:
    """(height, width, 3) of every camera, from the format of raw frames or the header of images.

    A video takes the declared size if there is one (``declared``, width and height), else that
    of the parameter set in its packet, else its ``format`` row.
    """
    still = images.image_size(F.when(F.col("kind") == "encoded_image", F.col("sample")))
    shown = stream_size(F.when(F.col("kind") == "video", F.col("sample")), F.col("source_codec"))
    rows = resolved.join(samples.select(*keys, "sample", "format"), list(keys), "left")
    rows = rows.withColumns({"_still": still, "_shown": shown})
    declared = {n: F.col(f"declared.{n}") if "declared" in resolved.columns else F.lit(None).cast("int") for n in ("height", "width")}
    size = {n: F.coalesce(declared[n], F.col(f"_still.{n}"), F.col(f"_shown.{n}"), F.col(f"format.{n}").cast("int")) for n in declared}
    height, width = size["height"], size["width"]
    known = height.isNotNull() & width.isNotNull()
    return rows.select(
        *keys,
        F.col("feature_key").alias("feature"),
        F.col("feature_dtype").alias("dtype"),
        F.when(known, F.array(height.cast("long"), width.cast("long"), F.lit(3).cast("long"))).alias("shape"),
        F.array(F.lit("height"), F.lit("width"), F.lit("channels")).alias("names"),
        F.when(~known, F.lit("could not infer the frame size")).alias("error"),
    )
