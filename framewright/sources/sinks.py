"""Writing a dataset: frames, episodes, tasks, packets and metadata as Parquet and JSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REFUSE = "errorifexists"
ROWS_PER_FILE = 1_000_000


def _by_address(table: DataFrame, number: str, rows_per_file: int) -> DataFrame:
    """Rows numbered from 0 without holes, in files of ``rows_per_file`` consecutive numbers.

    A row's number gives its file, so nothing is sampled and no file depends on the values.
    """
    last = table.agg(F.max(number)).first()[0]
    files = 1 if last is None else last // rows_per_file + 1
    placed = table.repartitionById(files, F.expr(f"cast(`{number}` div {rows_per_file} as int)"))
    return placed.sortWithinPartitions(number)


def write_frames(frames: DataFrame, path: str, *, squeeze: Sequence[str] = (), rows_per_file: int = ROWS_PER_FILE) -> None:
    """Frames in dataset order, cut by their ``index`` so that a long episode spans several files.

    Vectors named in ``squeeze`` have one element and are stored as plain numbers.
    """
    for name in squeeze:
        frames = frames.withColumn(name, F.get(F.col(f"`{name}`"), F.lit(0)))
    _by_address(frames, "index", rows_per_file).write.mode(REFUSE).parquet(f"{path}/data")


def write_episodes(episodes: DataFrame, path: str, *, rows_per_file: int = ROWS_PER_FILE) -> None:
    _by_address(episodes, "episode_index", rows_per_file).write.mode(REFUSE).parquet(f"{path}/meta/episodes")


def write_table(table: DataFrame, path: str, name: str) -> None:
    table.write.mode(REFUSE).parquet(f"{path}/{name}")


def dataset_info(episodes: DataFrame, features: Mapping[str, Mapping[str, object]], fps: int, encoder: str) -> DataFrame:
    """One row with the dataset's metadata as JSON."""
    totals = episodes.agg(
        F.count(F.lit(1)).alias("total_episodes"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_frames")
    )
    described = [
        F.struct(
            F.lit(spec["dtype"]).alias("dtype"),
            F.array(*[F.lit(n) for n in spec["shape"]]).alias("shape"),
            (F.array(*[F.lit(n) for n in spec["names"]]) if spec.get("names") else F.lit(None).cast("array<string>")).alias(
                "names"
            ),
        ).alias(name)
        for name, spec in features.items()
    ]
    info = F.struct(
        F.lit(fps).alias("fps"),
        F.lit(encoder).alias("video_encoder"),
        F.col("total_episodes"),
        F.col("total_frames"),
        F.struct(*described).alias("features"),
    )
    return totals.select(F.to_json(info).alias("value"))


def write_info(info: DataFrame, path: str) -> None:
    """The metadata row as text; a single row, so a single file."""
    info.coalesce(1).write.mode(REFUSE).text(f"{path}/meta/info")
