"""Camera bytes: codec and size from headers, raw pixels to RGB."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewright.functions.vectors import flatten_all

# Channel count of a raw buffer and the colour model it is read as.
COLOR_MODELS = {1: "L", 3: "RGB", 4: "RGBA"}


@F.pandas_udf(T.BinaryType())
def _join_bytes(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else np.asarray(v).astype(np.uint8).tobytes())


def blob_to_bytes(value: Column, kind: T.DataType) -> Column:
    """Binary value of a blob column: the first instance of a nested list, or the bytes themselves."""
    if isinstance(kind, T.BinaryType):
        return value
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.BinaryType):
        return F.get(value, F.lit(0))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.ArrayType):
        return _join_bytes(flatten_all(F.get(value, F.lit(0)), kind.elementType).cast("array<int>"))
    return _join_bytes(value.cast("array<int>"))


def blob_length(value: Column, kind: T.DataType) -> Column:
    """Bytes of a blob column, without making them one value; null where ``blob_to_bytes`` is null."""
    if isinstance(kind, T.BinaryType):
        return F.octet_length(value).cast("long")
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.BinaryType):
        return F.octet_length(F.get(value, F.lit(0))).cast("long")
    flat = flatten_all(F.get(value, F.lit(0)), kind.elementType) if isinstance(kind.elementType, T.ArrayType) else value
    return F.when(flat.isNotNull(), F.size(flat)).cast("long")


def _head(blob: Column, start: int, length: int) -> Column:
    return F.hex(F.substring(blob, start, length))


def image_codec(blob: Column) -> Column:
    """Codec of an encoded image from its first bytes."""
    # File signatures.
    return (
        F.when(blob.isNull(), F.lit(None).cast("string"))
        .when(_head(blob, 1, 3) == "FFD8FF", "jpeg")
        .when(_head(blob, 1, 8) == "89504E470D0A1A0A", "png")
        .when(_head(blob, 1, 6).isin("474946383761", "474946383961"), "gif")
        .when((_head(blob, 1, 4) == "52494646") & (_head(blob, 9, 4) == "57454250"), "webp")
        .when(_head(blob, 1, 4).isin("49492A00", "4D4D002A"), "tiff")
        .when(_head(blob, 1, 2) == "424D", "bmp")
        .otherwise("unknown")
    )


def _big_endian(blob: Column, start: int, length: int) -> Column:
    return F.conv(_head(blob, start, length), 16, 10).try_cast("int")


def png_size(blob: Column) -> Column:
    """(height, width) of a PNG, read from its header chunk."""
    is_png = (image_codec(blob) == "png") & (F.octet_length(blob) >= 24)
    return F.struct(
        F.when(is_png, _big_endian(blob, 21, 4)).alias("height"),
        F.when(is_png, _big_endian(blob, 17, 4)).alias("width"),
    )


def _jpeg_frame(data: bytes | None) -> tuple[int | None, int | None]:
    at = 2
    while data is not None and at + 9 <= len(data) and data[at] == 0xFF:
        marker = data[at + 1]
        if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            return int.from_bytes(data[at + 5 : at + 7], "big"), int.from_bytes(data[at + 7 : at + 9], "big")
        if marker == 0xFF:
            at += 1
        elif marker == 0x01 or 0xD0 <= marker <= 0xD8:
            at += 2
        else:
            at += 2 + int.from_bytes(data[at + 2 : at + 4], "big")
    return None, None


_SIZE = T.StructType([T.StructField("height", T.IntegerType()), T.StructField("width", T.IntegerType())])


@F.pandas_udf(_SIZE)
def jpeg_size(blobs: pd.Series) -> pd.DataFrame:
    """(height, width) of a JPEG, from its frame header."""
    sizes = [_jpeg_frame(b) for b in blobs]
    return pd.DataFrame(sizes, columns=["height", "width"]).astype("Int32")


def image_size(blob: Column) -> Column:
    """(height, width) of an encoded image."""
    codec = image_codec(blob)
    jpeg = jpeg_size(F.when(codec == "jpeg", blob))
    png = png_size(blob)
    return F.struct(
        F.coalesce(png["height"], jpeg["height"]).alias("height"), F.coalesce(png["width"], jpeg["width"]).alias("width")
    )


def raw_channels(buffer: Column, width: Column, height: Column) -> Column:
    """(channels, color_model, error) of a raw 8-bit buffer; only 1, 3 and 4 channels are known."""
    area = width.cast("long") * height.cast("long")
    length = F.octet_length(buffer).cast("long")
    channels = F.when(area > 0, F.call_function("div", length, area).cast("int")).otherwise(0)
    model = F.lit(None).cast("string")
    for count, name in COLOR_MODELS.items():
        model = F.when(channels == count, F.lit(name)).otherwise(model)
    exact = channels.cast("long") * area == length
    error = (
        F.when(width.isNull() | height.isNull(), F.lit("missing image format"))
        .when(model.isNull(), F.lit("unsupported channel count"))
        .when(~exact, F.lit("buffer size does not match the format"))
    )
    return F.struct(channels.alias("channels"), model.alias("color_model"), error.alias("error"))


def _rgb(data: bytes, width: int, height: int, model: str) -> bytes | None:
    depth = {"L": 1, "RGB": 3, "BGR": 3, "RGBA": 4, "BGRA": 4}.get(model)
    if depth is None or len(data) != width * height * depth:
        return None
    pixels = np.frombuffer(data, dtype=np.uint8).reshape(-1, depth)
    order = {"L": [0, 0, 0], "RGB": [0, 1, 2], "RGBA": [0, 1, 2], "BGR": [2, 1, 0], "BGRA": [2, 1, 0]}[model]
    return pixels[:, order].tobytes()


@F.pandas_udf(T.BinaryType())
def raw_to_rgb(buffers: pd.Series, widths: pd.Series, heights: pd.Series, models: pd.Series) -> pd.Series:
    """RGB bytes of a raw 8-bit buffer in L, RGB, RGBA, BGR or BGRA; null when the size does not fit."""
    rows = zip(buffers, widths, heights, models, strict=True)
    return pd.Series([None if b is None or pd.isna(w) or pd.isna(h) else _rgb(b, int(w), int(h), m) for b, w, h, m in rows])


def rgb_frame(rgb: Column, width: Column, height: Column) -> Column:
    """An RGB frame in the shape of Spark's image source."""
    return F.struct(
        height.cast("int").alias("height"),
        width.cast("int").alias("width"),
        F.lit(3).alias("channels"),
        rgb.alias("data"),
    )


def _units() -> tuple[list[str], list[str]]:
    """The first two bytes of HEVC units and the first byte of H.264 units that may open a packet."""
    # HEVC unit types of slices, of random access pictures, of parameter sets, delimiter and messages.
    slices, access, sets = (0, 1, 6, 7, 8, 9), range(16, 22), (32, 33, 34, 35, 39, 40)
    lowest = [f"{2 * t:02X}01" for t in (*slices, *access, *sets)]
    # Slices of higher temporal layers; type 3 would be the message unit of H.264.
    higher = [f"{2 * t:02X}{layer:02X}" for t in (0, 1, 2, 4, 5, 6, 7, 8, 9) for layer in range(2, 8)]
    # H.264 unit types that carry a reference level, and the two that never do.
    h264 = [f"{32 * level + t:02X}" for level in (1, 2, 3) for t in (1, 5, 7, 8)] + ["01", "06", "09"]
    return lowest + higher, h264


def video_codec_probe(sample: Column, declared: Column | None = None) -> Column:
    """Codec of a video packet from its first unit header, else the declared one, else h264.

    Annex-B streams open with a start code; the two bytes after it tell H.264 from HEVC.
    An AV1 stream opens with a temporal delimiter or a sequence header.
    """
    start = F.when(_head(sample, 1, 4) == "00000001", 5).when(_head(sample, 1, 3) == "000001", 4)
    unit = F.hex(F.substring(sample, start, F.lit(2)))
    hevc, h264 = _units()
    av1 = (_head(sample, 1, 2) == "1200") | (_head(sample, 1, 1) == "0A")
    found = F.when(unit.isin(hevc), "hevc").when(F.substring(unit, 1, 2).isin(h264), "h264").when(av1, "av1")
    fallback = F.lit("h264") if declared is None else F.coalesce(declared, F.lit("h264"))
    return F.coalesce(found, fallback)
