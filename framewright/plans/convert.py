"""The whole conversion: recordings in, a numbered dataset out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.config import ConversionConfig
from framewright.functions import rules
from framewright.operators import cameras as cam
from framewright.operators import episodes as ep
from framewright.operators import profile as prof
from framewright.operators import rates
from framewright.operators.align import ORDINAL, SEGMENT, TIME
from framewright.operators.scans import number_all
from framewright.session import stage
from framewright.sources import recordings as rec
from framewright.sources import sinks


@dataclass(frozen=True)
class Dataset:
    """The tables of a converted dataset."""

    frames: DataFrame
    episodes: DataFrame
    tasks: DataFrame
    task_rows: DataFrame
    status: DataFrame
    features: dict[str, dict[str, object]]
    config: ConversionConfig
    encoder: str = "h264"
    camera_plan: DataFrame | None = None
    camera_frames: DataFrame | None = None
    cameras: DataFrame | None = None
    packets: DataFrame | None = None

    @property
    def squeeze(self) -> list[str]:
        """Vector features of one element, which are stored as plain numbers."""
        return [name for name in ep.VECTOR_FEATURES if self.features[name]["shape"] == [1]]

    def episode_tasks(self) -> DataFrame:
        """Tasks of every episode in the order in which they appear."""
        placed = ep.episode_tasks(self.task_rows, rows_per_chunk=self.config.rows_per_chunk)
        placed = placed.join(self.episodes.select(SEGMENT, "episode_index"), [SEGMENT])
        placed = placed.join(self.tasks.select(ep.TASK, "task_index"), [ep.TASK])
        return placed.select("episode_index", SEGMENT, "position", "task_index", ep.TASK)

    def stats(self) -> DataFrame:
        """Statistics per episode, feature and position."""
        return ep.episode_stats(self.frames)

    def summary(self) -> DataFrame:
        return ep.conversion_summary(self.status)


def read_features(inferred: DataFrame) -> dict[str, dict[str, object]]:
    """The inferred features of one segment on the driver: one row per feature. Raises on a fault."""
    features = {}
    for row in inferred.collect():
        if row["error"] or row["shape"] is None:
            raise ValueError(f"{row['feature']}: {row['error']}")
        features[row["feature"]] = {"dtype": row["dtype"], "shape": list(row["shape"]), "names": row["names"]}
    return features


def _resolve(recording: DataFrame, samples: DataFrame, config: ConversionConfig) -> DataFrame:
    spark = recording.sparkSession
    specs = spark.createDataFrame(
        [(v.key, v.path, v.video_format, v.size) for v in config.videos],
        "camera_key string, path string, video_format string, declared struct<width:int,height:int>",
    )
    columns = spark.createDataFrame([(c,) for c in recording.columns], "name string")
    return cam.resolve_cameras(cam.camera_kinds(specs, columns), samples, config.output_format)


def select_segments(
    recording: DataFrame,
    config: ConversionConfig,
    *,
    segments: Sequence[str] | None = None,
    max_segments: int | None = None,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """The segments to convert with their place and profile; one row each.

    One pass over the recording finds the segments and all that is needed of them
    before the alignment. A segment that is listed but not there has no rows; one whose
    known size is 0 is not looked at.
    """
    rows = ep.prepare(recording, config)
    if segments:
        listed = rec.place_segments(recording.sparkSession, segments)
        rows = rec.filter_segments(rows, listed)
    profile = prof.segment_profile(rows, config.scalar_columns, config.reference_column)
    if segments:
        profile = listed.join(profile, [SEGMENT], "left")
        profile = profile.withColumn("length", F.coalesce("length", F.lit(0)))
    else:
        profile = stage(profile, "profile")
        profile = number_all(profile, [SEGMENT], "seg_pos", rows_per_chunk=config.rows_per_chunk)
    if max_segments is not None:
        profile = profile.where(F.col("seg_pos") < max_segments)
    if sizes is not None:
        profile = profile.join(sizes.select(SEGMENT, "size_bytes"), [SEGMENT], "left")
    else:
        profile = profile.withColumn("size_bytes", F.lit(None).cast("long"))
    return stage(profile, "segments")


def finalize_dataset(
    dense: DataFrame,
    profile: DataFrame,
    config: ConversionConfig,
    features: dict[str, dict[str, object]],
    *,
    lacking: DataFrame | None = None,
    encoder: str = "h264",
) -> Dataset:
    """Number aligned rows: episodes, frames and tasks.

    ``dense`` and ``profile`` are staged tables, since each is read several times.
    ``lacking`` names segments that fail for another reason, such as a missing camera.
    """
    errors = ep.segment_errors(dense, profile, config)
    if lacking is not None:
        both = errors.join(lacking.withColumnRenamed("reason", "_reason"), [SEGMENT], "full")
        errors = both.select(SEGMENT, F.coalesce("reason", "_reason").alias("reason"))
    status = stage(ep.segment_status(profile, errors), "status")
    order = ["seg_pos"] if "seg_pos" in status.columns else [SEGMENT]
    episodes = stage(ep.number_episodes(status, order, rows_per_chunk=config.rows_per_chunk), "episodes")

    task_rows = stage(ep.episode_task_rows(dense), "task-rows")
    tasks = stage(ep.number_tasks(task_rows, episodes, rows_per_chunk=config.rows_per_chunk), "tasks")
    return Dataset(
        frames=ep.number_frames(dense, task_rows, episodes, tasks, config),
        episodes=episodes,
        tasks=tasks,
        task_rows=task_rows,
        status=status,
        features=features,
        config=config,
        encoder=encoder,
    )


def convert_dataset(
    recording: DataFrame,
    config: ConversionConfig,
    *,
    cameras: DataFrame | None = None,
    segments: Sequence[str] | None = None,
    max_segments: int | None = None,
    sizes: DataFrame | None = None,
) -> Dataset:
    """Convert all segments of a recording in one go.

    Three passes: a profile of the raw columns per segment, the alignment (whose dense
    rows are written to the scratch folder once), and the numbering of those rows. A
    faulty segment is set aside and the others go on. The features come from the first
    segment; a fault there raises.
    """
    profile = select_segments(recording, config, segments=segments, max_segments=max_segments, sizes=sizes)
    first = profile.agg(F.min_by(SEGMENT, "seg_pos").alias(SEGMENT)).collect()[0][SEGMENT]
    if first is None:
        raise ValueError("no segments found")
    rows = ep.prepare(recording, config)
    features = read_features(prof.infer_features(rows.where(F.col(SEGMENT) == first), config))

    resolved, index, encoder = None, None, "h264"
    if config.videos:
        if cameras is None:
            parts = [rec.camera_reader(recording, v.path, v.key, config.camera_timeline(v)) for v in config.videos]
            cameras = rec.union_recordings(parts)
            found = rec.camera_index(recording, [(v.path, v.key, config.camera_timeline(v)) for v in config.videos])
        else:
            found = cam.camera_index(cameras)
        # what follows asks this table where and when frames are; bytes are read again only to be written
        index = stage(found, "camera-index")
        here = F.col(SEGMENT) == first
        samples = stage(cam.first_samples(cameras.where(here), index=index.where(here)).drop(SEGMENT), "first-samples")
        resolved = stage(_resolve(recording, samples, config), "cameras")
        features |= read_features(cam.camera_features(resolved, samples))
        encoder = rules.ENCODERS.get((config.output_format or "").lower(), "h264")

    chosen = recording
    if segments or max_segments is not None or sizes is not None:
        wanted = profile.where(F.coalesce(F.col("size_bytes"), F.lit(1)) != 0)
        chosen = rec.filter_segments(recording, wanted)
    action_dim, state_dim = features[ep.ACTION]["shape"][0], features[ep.STATE]["shape"][0]
    dense = stage(ep.build_episodes(chosen, config, action_dim=action_dim, state_dim=state_dim), "aligned")
    lacking = None if resolved is None else _camera_errors(profile, index, config)
    dataset = finalize_dataset(dense, profile, config, features, lacking=lacking, encoder=encoder)
    return dataset if resolved is None else _with_cameras(dataset, dense, cameras, index, resolved, config)


def _camera_errors(profile: DataFrame, index: DataFrame, config: ConversionConfig) -> DataFrame:
    """Segments that lack frames of a camera fail, like those that lack a scalar column."""
    held = index.groupBy(SEGMENT, cam.CAMERA).agg(F.count(F.lit(1)).alias("_n"))
    wanted = F.array(*[F.lit(v.key) for v in config.videos])
    asked = profile.where(F.col("length") > 0).select(SEGMENT, F.explode(wanted).alias(cam.CAMERA))
    lacking = asked.join(held, [SEGMENT, cam.CAMERA], "left_anti").groupBy(SEGMENT).agg(F.min(cam.CAMERA).alias("_camera"))
    reason = F.concat(F.lit("no samples for camera '"), F.col("_camera"), F.lit("'"))
    return lacking.select(SEGMENT, reason.alias("reason"))


def _with_cameras(
    dataset: Dataset, dense: DataFrame, cameras: DataFrame, index: DataFrame, resolved: DataFrame, config: ConversionConfig
) -> Dataset:
    keys = [SEGMENT, cam.CAMERA]
    numbered = dataset.episodes.select(SEGMENT, "episode_index")
    measured = rates.source_fps(index, keys, rows_per_chunk=config.rows_per_chunk)
    plan = rates.episode_video_plan(measured, resolved, config.fps)
    plan = stage(plan.join(numbered, [SEGMENT]), "camera-plan")

    # Episodes that are copied as a whole need no frame at all.
    decoded = plan.where(~F.col("copy_all")).select(SEGMENT).distinct()
    targets = dense.join(decoded, [SEGMENT], "left_semi")
    elapsed = [v.key for v in config.videos if config.camera_timeline(v) != config.index_column]
    videos = [r[cam.CAMERA] for r in resolved.where(F.col("kind") == "video").select(cam.CAMERA).collect()]
    aligned = cam.camera_align(
        targets,
        index,
        [v.key for v in config.videos],
        elapsed=elapsed,
        video=videos,
        rows_per_chunk=config.rows_per_chunk,
    )
    copied = plan.where(F.col("mode") == "copy").select(*keys, "episode_index")
    manifest = cam.packet_manifest(index, rows_per_chunk=config.rows_per_chunk).join(copied, keys)
    return replace(
        dataset, camera_plan=plan, camera_frames=aligned.join(numbered, [SEGMENT]), cameras=cameras, packets=manifest
    )


def refuse_existing(spark: SparkSession, path: str) -> None:
    """Raise when ``path`` exists, also when an earlier run has left only part of a dataset."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing):
            return
        raise
    raise ValueError(f"output already exists: {path}")


def write_dataset(dataset: Dataset, path: str) -> None:
    """Write every table of a dataset; an existing output is refused."""
    spark = dataset.frames.sparkSession
    refuse_existing(spark, path)
    sinks.write_frames(dataset.frames, path, squeeze=dataset.squeeze)
    written = spark.read.parquet(f"{path}/data")
    vectors = [n for n in ep.VECTOR_FEATURES if n not in dataset.squeeze]
    stats = ep.episode_stats(written, vector_features=vectors, scalar_features=[*dataset.squeeze, *ep.SCALAR_FEATURES])
    columns = ["episode_index", SEGMENT, "length", "dataset_from_index", "dataset_to_index"]
    sinks.write_episodes(dataset.episodes.select(*columns), path)
    sinks.write_table(ep.pack_stats(stats), path, "meta/episode_stats")
    sinks.write_table(dataset.tasks.select("task_index", ep.TASK), path, "meta/tasks")
    sinks.write_table(dataset.episode_tasks(), path, "meta/episode_tasks")
    sinks.write_table(dataset.status, path, "meta/segments")
    if dataset.camera_plan is not None:
        sinks.write_table(dataset.camera_plan, path, "meta/cameras")
        sinks.write_table(dataset.camera_frames, path, "meta/camera_frames")
        sinks.write_table(dataset.packets, path, "videos/manifest")
        copied = dataset.camera_plan.where(F.col("mode") == "copy").select(SEGMENT, cam.CAMERA, "episode_index")
        sinks.write_table(cam.copied_packets(dataset.cameras, copied), path, "videos/packets")
        # Copied cameras keep their packets; the others need the frames some row uses.
        decoded = dataset.camera_plan.where(F.col("mode") != "copy").select(SEGMENT, cam.CAMERA)
        used = dataset.camera_frames.join(decoded, [SEGMENT, cam.CAMERA], "left_semi")
        sinks.write_table(cam.frame_pick(used, dataset.cameras), path, "images/frames")
    sinks.write_info(sinks.dataset_info(dataset.episodes, dataset.features, dataset.config.fps, dataset.encoder), path)


def convert_directory(
    spark: SparkSession, source: str, output: str, config: ConversionConfig, **options: object
) -> Dataset:
    """Convert a folder of recordings and write the dataset."""
    refuse_existing(spark, output)
    dataset = convert_dataset(rec.read_recordings(spark, source), config, **options)
    write_dataset(dataset, output)
    return dataset


def convert_catalog(spark: SparkSession, name: str, output: str, config: ConversionConfig, **options: object) -> Dataset:
    """Convert a table of the catalog and write the dataset."""
    refuse_existing(spark, output)
    dataset = convert_dataset(rec.read_catalog(spark, name), config, **options)
    write_dataset(dataset, output)
    return dataset
