"""Join helpers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMALL_BYTES = 10 << 20


def is_small(frame: DataFrame, max_bytes: int = SMALL_BYTES) -> bool:
    """Whether Spark knows a frame to be small enough for a broadcast.

    The size is the one Spark plans with, from the sizes of files; no job is
    run for it. Joins are taken at the product of their sides.
    """
    return planned_bytes(frame) <= max_bytes


def planned_bytes(frame: DataFrame) -> int:
    """The size Spark plans with; no job is run for it."""
    return int(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_if_small(frame: DataFrame, max_bytes: int = SMALL_BYTES) -> DataFrame:
    """Mark a side for broadcast only if it ``is_small``; else Spark decides."""
    return F.broadcast(frame) if is_small(frame, max_bytes) else frame


def same_keys(left: Sequence[str], right: Sequence[str]) -> Column:
    """Equality of key lists where null equals null."""
    return reduce(and_, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)])


def attach(frame: DataFrame, extra: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the columns of ``extra`` to the rows with the same keys.

    ``extra`` may be derived from ``frame``. Null keys match each other, as
    they share a group in an aggregate.
    """
    marks = [f"_match_{key}" for key in keys]
    renamed = extra.select(
        *[F.col(key).alias(mark) for key, mark in zip(keys, marks, strict=True)],
        *[F.col(name) for name in extra.columns if name not in keys],
    )
    return frame.join(renamed, same_keys(keys, marks), "inner").drop(*marks)


def label_twice(
    frame: DataFrame, names: DataFrame, key: str, label: str, roles: dict[str, str]
) -> DataFrame:
    """Look up one dimension in several roles, keeping unmatched rows.

    ``roles`` maps a key column of ``frame`` to the name its label gets.
    """
    for column, target in roles.items():
        role = names.select(F.col(key).alias(f"_{target}_key"), F.col(label).alias(target))
        frame = frame.join(role, F.col(column) == F.col(f"_{target}_key"), "left").drop(
            f"_{target}_key"
        )
    return frame
