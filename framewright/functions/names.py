"""Column names, dataset addresses and small specifications, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parts of the column-naming format.
VIDEO_FEATURE_PREFIX = "observation.images."
SAMPLE_SUFFIX = {"video": ":VideoStream:sample", "encoded_image": ":EncodedImage:blob", "raw_image": ":Image:buffer"}


def entity_path(name: Column) -> Column:
    """Text before the first colon; null for null."""
    return F.split_part(name, F.lit(":"), F.lit(1))


def column_parts(name: Column) -> Column:
    """entity_path, component and field of a fully qualified column name."""
    parts = [F.split_part(name, F.lit(":"), F.lit(i)) for i in (1, 2, 3)]
    return F.struct(parts[0].alias("entity_path"), parts[1].alias("component"), parts[2].alias("field"))


def starts_with_any(name: Column, prefixes: Sequence[str]) -> Column:
    hit = F.lit(False)
    for prefix in prefixes:
        hit = hit | F.startswith(name, F.lit(prefix))
    return hit


def split_dataset_url(url: Column) -> Column:
    """(catalog_url, entry_id, error): accepts ``scheme://host/entry/<id>`` or one path part."""
    # Fragment and query do not belong to the path.
    pattern = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]+)([^?#]*)"
    scheme = F.lower(F.regexp_extract(url, pattern, 1))
    host = F.regexp_extract(url, pattern, 2)
    parts = F.filter(F.split(F.regexp_extract(url, pattern, 3), "/"), lambda p: p != "")
    count = F.size(parts)
    last = F.try_element_at(parts, F.lit(-1))
    named = (count >= 2) & (F.try_element_at(parts, F.lit(-2)) == "entry")
    valid = scheme != ""
    found = valid & (named | (count == 1))
    return F.struct(
        F.when(found, F.concat(scheme, F.lit("://"), host)).alias("catalog_url"),
        F.when(found, last).alias("entry_id"),
        F.when(~F.coalesce(valid, F.lit(False)), F.lit("invalid dataset url"))
        .when(~F.coalesce(found, F.lit(False)), F.lit("no entry id"))
        .alias("error"),
    )


def parse_video_spec(spec: Column) -> Column:
    """(key, path, index, error) of ``key:path`` or ``key:path:index``."""
    parts = F.split(spec, ":", -1)
    good = F.size(parts).isin(2, 3)

    def part(i: int) -> Column:
        return F.when(good, F.get(parts, F.lit(i)))

    return F.struct(
        part(0).alias("key"),
        part(1).alias("path"),
        part(2).alias("index"),
        F.when(~F.coalesce(good, F.lit(False)), F.lit("expected key:path or key:path:index")).alias("error"),
    )


def parse_name_list(raw: Column) -> Column:
    """Comma list with blanks trimmed and empty items dropped; null when nothing is left."""
    items = F.transform(F.split(raw, ","), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    kept = F.filter(items, lambda x: x != "")
    return F.when(F.size(kept) > 0, kept)


def video_key_guess(path: Column) -> Column:
    """Last part of a path, or ``cam``."""
    last = F.element_at(F.split(F.rtrim(path, F.lit("/")), "/"), -1)
    return F.coalesce(F.nullif(last, F.lit("")), F.lit("cam"))


def camera_feature_key(key: Column) -> Column:
    return F.concat(F.lit(VIDEO_FEATURE_PREFIX), key)


def sample_column(kind: Column, path: Column) -> Column:
    """The column that holds a camera's frames."""
    return (
        F.when(kind == "video", F.concat(path, F.lit(SAMPLE_SUFFIX["video"])))
        .when(kind == "encoded_image", F.concat(path, F.lit(SAMPLE_SUFFIX["encoded_image"])))
        .otherwise(F.concat(path, F.lit(SAMPLE_SUFFIX["raw_image"])))
    )
