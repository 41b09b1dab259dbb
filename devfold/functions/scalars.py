"""Scalar and aggregate column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def time_slice(ts: str | Column, minutes: int = 10) -> Column:
    """1-based slice of the day; the date plays no part, a null time gives null."""
    ts = _col(ts)
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return (F.floor(seconds / (minutes * 60)) + 1).cast("int")


def encode_gender(gender: str | Column) -> Column:
    """``F`` is 0, any other value 1, missing stays missing."""
    gender = _col(gender)
    return F.when(gender.isNull(), None).when(gender == "F", 0).otherwise(1).cast("int")


def to_int(text: str | Column) -> Column:
    """Text to INT; text that is no integer becomes null."""
    return _col(text).try_cast("int")


def label_map(labels: str | Column, counts: str | Column) -> Column:
    """Two comma-joined lists as ``map<label, count>``; a repeated label keeps its first count."""
    ids = F.transform(F.split(_col(labels), ","), lambda x: x.try_cast("int"))
    values = F.transform(F.split(_col(counts), ","), lambda x: x.try_cast("bigint"))
    entries = F.transform(
        ids,
        lambda x, i: F.struct(
            x.alias("label"),
            F.get(values, i).alias("count"),
            (F.array_position(ids, x) == i + 1).alias("is_first"),
        ),
    )
    kept = F.filter(entries, lambda e: e["is_first"])
    return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["label"], e["count"])))


def group_concat(column: str, order_by: str, sep: str = ",") -> Column:
    """Ordered string aggregate: nulls are skipped, an empty group gives ``''``."""
    return F.expr(
        f"coalesce(listagg(cast(`{column}` as string), '{sep}') "
        f"within group (order by `{order_by}`), '')"
    )


def hash_bucket(key: str | Column, buckets: int = 10_000, seed: int = 0) -> Column:
    """Stable bucket 0..buckets-1 of a key, the same under any partitioning or engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), _col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets
