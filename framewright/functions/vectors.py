"""Numeric vectors and task texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _depth(kind: T.DataType) -> int:
    layers = 0
    while isinstance(kind, T.ArrayType):
        kind = kind.elementType
        layers += 1
    return layers


def leaf_type(kind: T.DataType) -> T.DataType:
    """The type below all list layers."""
    while isinstance(kind, T.ArrayType):
        kind = kind.elementType
    return kind


def castable_to_float32(kind: T.DataType) -> bool:
    return isinstance(leaf_type(kind), (T.IntegralType, T.FloatType, T.DoubleType))


def flatten_all(value: Column, kind: T.DataType) -> Column:
    """A value of any list depth as one flat array; a scalar gives an array of one."""
    layers = _depth(kind)
    if layers == 0:
        return F.when(value.isNotNull(), F.array(value))
    for _ in range(layers - 1):
        value = F.flatten(value)
    return value


def float32_vector(value: Column, kind: T.DataType) -> Column:
    """Flat single-precision vector; nulls inside become NaN, a null value stays null."""
    flat = flatten_all(value, kind).cast("array<float>")
    return F.transform(flat, lambda x: F.coalesce(x, F.lit(float("nan")).cast("float")))


def concat_vectors(vectors: Sequence[Column]) -> Column:
    """The vectors one after the other; null when one of them is null."""
    return vectors[0] if len(vectors) == 1 else F.concat(*vectors)


def vector_error(vector: Column, expected_dim: Column | int, label: str) -> Column:
    """Why ``vector`` cannot be a feature, or null. An expected dimension of -1 accepts any length."""
    expected = expected_dim if isinstance(expected_dim, Column) else F.lit(expected_dim)
    wrong = (expected != -1) & (F.size(vector) != expected)
    message = F.concat(
        F.lit(f"{label} has dim "), F.size(vector).cast("string"), F.lit(" but expected "), expected.cast("string")
    )
    return F.when(vector.isNull(), F.lit(f"missing {label} value")).when(wrong, message)


def unwrap_singleton(value: Column) -> Column:
    """The element of a list of length one, otherwise null; pair it with the list itself."""
    return F.when(F.size(value) == 1, F.get(value, F.lit(0)))


def task_text(value: Column, kind: T.DataType, default: str) -> Column:
    """Task text of a row: unwrapped, decoded, joined with blanks when it has several parts."""
    leaf = leaf_type(kind)

    def text(item: Column) -> Column:
        if isinstance(leaf, T.BinaryType):
            return F.when(F.is_valid_utf8(item.cast("string")), item.cast("string"))
        return item.cast("string")

    if isinstance(kind, T.ArrayType):
        flat = flatten_all(value, kind)
        # An empty list has no text of its own.
        joined = F.array_join(F.transform(flat, text), " ")
        resolved = F.when(F.size(flat) == 1, text(F.get(flat, F.lit(0)))).when(F.size(flat) > 1, joined)
    else:
        resolved = text(value)
    return F.coalesce(resolved, F.lit(default))
