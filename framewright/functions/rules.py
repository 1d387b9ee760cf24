"""Rules that decide how a camera is read and stored, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats a dataset can store, and the encoder name of each video codec.
IMAGE_FORMATS = ("png",)
VIDEO_FORMATS = ("h264", "hevc", "av1")
ENCODERS = {"h264": "h264", "hevc": "hevc", "av1": "libsvtav1"}


def detect_camera_kind(has_video: Column, has_encoded: Column, has_raw: Column) -> Column:
    """video before encoded_image before raw_image; null when the entity holds no frames."""
    return F.when(has_video, "video").when(has_encoded, "encoded_image").when(has_raw, "raw_image")


def validate_output_format(requested: Column) -> Column:
    """(format, error) of a requested output format; null means keep the source format."""
    lowered = F.lower(requested)
    known = lowered.isin(*IMAGE_FORMATS, *VIDEO_FORMATS)
    return F.struct(
        F.when(known, lowered).alias("format"),
        F.when(requested.isNull() | known, F.lit(None).cast("string"))
        .when(lowered.isin("jpg", "jpeg"), F.lit("jpeg frames cannot be stored"))
        .otherwise(F.lit("unknown output format"))
        .alias("error"),
    )


def resolve_output_format(kind: Column, source_codec: Column, requested: Column) -> Column:
    """The requested format, else the source's own where it can be stored, else h264."""
    keeps = (kind == "video") & source_codec.isin(*VIDEO_FORMATS)
    is_png = (kind == "encoded_image") & (source_codec == "png")
    return F.coalesce(requested, F.when(keeps | is_png, source_codec), F.lit("h264"))


def feature_dtype(output_format: Column) -> Column:
    return F.when(output_format.isin(*IMAGE_FORMATS), "image").otherwise("video")


def can_copy(kind: Column, source_codec: Column, output_format: Column) -> Column:
    """Packets may be copied when a video already has the requested codec."""
    same = (kind == "video") & output_format.isin(*VIDEO_FORMATS) & (source_codec == output_format)
    return F.coalesce(same, F.lit(False))


def dataset_encoder(output_format: Column) -> Column:
    """Encoder for frames that must be encoded again."""
    name = F.lit("h264")
    for fmt, encoder in ENCODERS.items():
        name = F.when(output_format == fmt, F.lit(encoder)).otherwise(name)
    return name
