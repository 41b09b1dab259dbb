"""Profiles as sparse vectors: one vector column per feature block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devfold.operators.features import placed_inside
from devfold.schemas import FeatureSpace

BLOCKS = ["labels", "time", "clusters"]

# How a vector is stored (kind 0 is sparse).
FIELDS = [
    pa.field("type", pa.int8(), False),
    pa.field("size", pa.int32()),
    pa.field("indices", pa.list_(pa.int32())),
    pa.field("values", pa.list_(pa.float64())),
]


def _sparse(entries: DataFrame, size: int, name: str) -> DataFrame:
    """Rows ``(device_id, at, v)``, sorted by device, to one sparse vector column.

    A whole Arrow batch becomes vectors at once: its columns are the vectors' own fields, so
    nothing is touched row by row. The last device of a batch waits for the next one.
    """

    def vectors(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        at = table.column("at").combine_chunks()
        known = at.is_valid().to_numpy(zero_copy_only=False)
        offsets = pa.array(np.append(0, np.cumsum(known))[np.append(starts, len(known))], pa.int32())
        device = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(known))))[known]
        places = device * size + at.filter(pa.array(known)).to_numpy()
        kept = table.filter(pa.array(known)).take(pa.array(np.argsort(places, kind="stable")))
        kind, width = np.zeros(len(starts), np.int8), np.full(len(starts), size, np.int32)
        lists = [pa.ListArray.from_arrays(offsets, kept.column(i).combine_chunks()) for i in (1, 2)]
        parts = [pa.array(kind), pa.array(width), *lists]
        return pa.RecordBatch.from_arrays(
            [table.column(0).take(pa.array(starts)).combine_chunks(), pa.StructArray.from_arrays(parts, fields=FIELDS)],
            names=["device_id", name],
        )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = (table if held is None else pa.concat_tables([held, table])).combine_chunks()
            codes = table.column(0).chunk(0).dictionary_encode(null_encoding="encode").indices.to_numpy()
            starts = np.append(0, np.flatnonzero(np.diff(codes)) + 1)
            held = table.slice(starts[-1])
            if len(starts) > 1:
                yield vectors(table.slice(0, starts[-1]), starts[:-1])
        if held is not None:
            yield vectors(held, np.array([0]))

    schema = T.StructType([entries.schema["device_id"]]).add(name, VectorUDT(), True, {"ml_attr": {"num_attrs": size}})
    return entries.mapInArrow(build, schema)


def block_vectors(
    counts: DataFrame, position: Column, value: str, size: int, name: str
) -> DataFrame:
    """One sparse vector of ``size`` entries per device that has rows in ``counts``.

    ``counts`` has one row per device and key; a position beyond ``size`` ends the run,
    so a device never has more than ``size`` entries. Rows without a key or value are no entries.
    Rows are sorted by device, not collected into a list for each; counts dealt by device stay where they are.
    """
    position = placed_inside(position.cast("int"), size, name)
    known = F.when(position.isNotNull() & F.col(value).isNotNull(), position)
    entries = counts.repartition("device_id").select("device_id", known.alias("at"), F.col(value).cast("double").alias("v"))
    return _sparse(entries.sortWithinPartitions("device_id"), size, name)


def profile_vectors(
    attributes: DataFrame,
    label_counts: DataFrame,
    slice_counts: DataFrame,
    totals: DataFrame,
    cluster_counts: DataFrame,
    space: FeatureSpace,
) -> DataFrame:
    """Attributes with the blocks ``labels``, ``time``, ``clusters`` and the two totals.

    A block is null for a device that has none of its rows, which is not the same
    as a vector of zeros. Every input is hashed by device, so the joins are local.
    """
    labels = block_vectors(label_counts, F.col("label_id") - 1, "ile", space.labels, "labels")
    time = block_vectors(slice_counts, F.col("slice") - 1, "c", space.slices, "time")
    where = block_vectors(cluster_counts, F.col("cluster"), "n", space.clusters, "clusters")
    return (
        attributes.join(labels, "device_id", "left")
        .join(time, "device_id", "left")
        .join(totals.select("device_id", "allev", "nolat"), "device_id", "left")
        .join(where, "device_id", "left")
    )


def block_means(df: DataFrame, blocks: list[str] = BLOCKS) -> dict[str, list[float]]:
    """Mean vector per block over the devices that have it (a model of fixed width)."""
    means = {}
    for block in blocks:
        found = df.where(F.col(block).isNotNull()).select(Summarizer.mean(F.col(block))).head()[0]
        width = df.schema[block].metadata["ml_attr"]["num_attrs"]
        means[block] = found.toArray().tolist() if found is not None and found.size else [0.0] * width
    return means


def _numbers(values: list[float]) -> Column:
    """An array of numbers as one literal: with one for each number every later stage of a pipeline would analyse them all."""
    return F.split(F.lit(" ".join(map(repr, values))), " ").cast("array<double>")


def fill_blocks(df: DataFrame, means: dict[str, list[float]]) -> DataFrame:
    """Missing blocks replaced by their mean vector."""
    return df.withColumns(
        {
            block: F.coalesce(F.col(block), array_to_vector(_numbers(mean))).alias(
                block, metadata={"ml_attr": {"num_attrs": len(mean)}}
            )
            for block, mean in means.items()
        }
    )
