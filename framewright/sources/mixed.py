"""Recordings whose files store one column with different types."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_CONFLICTS = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE")


# PySpark hands the conflict on as the JVM raised it
READ_ERRORS = (PySparkException, Py4JJavaError)


def is_conflict(error: Exception) -> bool:
    """Whether ``error`` says that files have columns of types that do not merge."""
    return any(name in str(error) for name in _CONFLICTS)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type that both cast to, or None.

    Whole numbers take the wider of the two; beside a float, those of more than 16 bits take double
    (a 64-bit number above 2^53 is rounded there). Lists and structs are matched inside; a field that
    one struct lacks is null. Numbers never become text.
    """
    if a == b:
        return a
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda kind: _WHOLE.index(type(kind)))
    numbers = (*_WHOLE, T.FloatType, T.DoubleType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        small = (T.ByteType, T.ShortType, T.FloatType)
        return T.FloatType() if isinstance(a, small) and isinstance(b, small) else T.DoubleType()
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        inner = common_type(a.elementType, b.elementType)
        return inner and T.ArrayType(inner)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _common_struct(a, b)
    return None


def _common_struct(a: T.StructType, b: T.StructType) -> T.StructType | None:
    fields = {f.name: f.dataType for f in a}
    for f in b:
        kind = common_type(fields[f.name], f.dataType) if f.name in fields else f.dataType
        if kind is None:
            return None
        fields[f.name] = kind
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def common_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """The columns of all schemas with their least common types; raises where there is none."""
    kinds: dict[str, T.DataType] = {}
    for f in (f for schema in schemas for f in schema):
        kind = common_type(kinds[f.name], f.dataType) if f.name in kinds else f.dataType
        if kind is None:
            raise ValueError(f"column {f.name!r} is {kinds[f.name].simpleString()} in some files and {f.dataType.simpleString()} in others")
        kinds[f.name] = kind
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def _runs(reader, files: Sequence[str]) -> list[tuple[T.StructType, Sequence[str]]]:
    """Runs of files whose footers merge, found by halving: a run of any length costs one look."""
    try:
        return [(reader().parquet(*files).schema, files)]
    except READ_ERRORS as error:
        if len(files) == 1 or not is_conflict(error):
            raise
    half = len(files) // 2
    return _runs(reader, files[:half]) + _runs(reader, files[half:])


def _fit(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value in the wanted type; structs field by field, as a cast goes by their places."""
    if have == want:
        return value
    if isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: _fit(x, have.elementType, want.elementType))
    if isinstance(want, T.StructType):
        held = {f.name: f.dataType for f in have}
        fields = [(_fit(value[f.name], held[f.name], f.dataType) if f.name in held else F.lit(None).cast(f.dataType)).alias(f.name) for f in want]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value.cast(want)


def read_mixed(spark: SparkSession, path: str, lacking: Mapping[str, Column] | None = None) -> DataFrame:
    """All Parquet files below ``path``; a column takes the least common type of all files.

    Files are grouped by the types of the columns in conflict. Each group is read with its own schema
    and cast, so there are as many scans as groups, and each keeps its pruning and filters. Footers
    are read by Spark: one look for a run of files that agree, and log2(files) more for each change.
    Columns that folders name (``column=value``) are text. ``lacking`` gives columns by the file of a
    row, for those that no file and no folder has.
    """
    plain = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "false").parquet(path)
    # names come percent-encoded, and signs of patterns stand for themselves
    files = sorted(re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(f)) for f in plain.inputFiles())
    infer = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(infer)
    # the part of a file's path below ``path`` alone can name columns
    root = path.rstrip("/")
    below = [f for f in files if root in f and re.search(r"/[^/=]+=[^/]*/", f.split(root, 1)[1])]

    def reader(schema: T.StructType | None = None):
        found = spark.read.option("mergeSchema", "true")
        if below:
            found = found.option("basePath", path)
        return found if schema is None else found.schema(schema)

    spark.conf.set(infer, "false")  # else a segment 007 would become 7
    try:
        runs = _runs(reader, files)
        whole = common_schema([schema for schema, _ in runs])
        kinds = {f.name: f.dataType for f in whole}
        changed = [f.name for f in whole if len({s[f.name].dataType for s, _ in runs if f.name in s.names}) > 1]
        more = {c: value for c, value in (lacking or {}).items() if c not in kinds}
        groups: dict[tuple, list] = {}
        for schema, members in runs:
            groups.setdefault(tuple(schema[c].dataType if c in schema.names else None for c in changed), []).append((schema, members))
        parts = []
        for group in groups.values():
            own = common_schema([schema for schema, _ in group])
            rows = reader(own).parquet(*[f for _, members in group for f in members])
            rows = rows.withColumns({c: _fit(F.col(f"`{c}`"), own[c].dataType, kinds[c]) for c in changed if c in own.names})
            parts.append(rows.select("*", *[value.alias(c) for c, value in more.items()]))
    finally:
        spark.conf.set(infer, before)
    joined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return joined.select(*[F.col(f"`{c}`") for c in [*whole.names, *more]])
