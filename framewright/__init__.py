"""Recordings to training episodes, on Spark."""

from framewright.config import ConversionConfig, VideoSpec
from framewright.plans.convert import convert_catalog, convert_dataset, convert_directory, write_dataset
from framewright.session import configure

__all__ = [
    "ConversionConfig",
    "VideoSpec",
    "configure",
    "convert_catalog",
    "convert_dataset",
    "convert_directory",
    "write_dataset",
]
