"""Feature profiles in long form: statistics, scaling, and the step to wide."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Imputer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devfold.operators.joins import spread_join
from devfold.operators.positions import numbered
from devfold.schemas import TOTALS
from devfold.session import materialize

LONG = ["device_id", "block", "feature", "value"]
#: Cells of a wide table that a task holds at once (8 bytes each).
WIDE_CELLS = 1_000_000
CELLS = ["_at", "_value", "_flag"]


# -- long and wide -------------------------------------------------------------


def placed_inside(position: Column, size: int, what: str) -> Column:
    """``position`` where it lies in ``0..size - 1``, null where it is null; others end the run.

    A vocabulary is a parameter. Data outside it must not vanish, so it is an error.
    """
    said = F.concat(F.lit(f"{what} outside the vocabulary of {size}: "), position.cast("string"))
    return F.when(position.isNull() | position.between(0, size - 1), position).otherwise(
        F.raise_error(said).cast("int")
    )


def outside_vocabulary(counts: DataFrame, key: str, value: str, first: int, size: int) -> DataFrame:
    """One row: distinct keys, rows and summed values that a vocabulary of ``size`` has no column for."""
    out = counts.where(F.col(key).isNotNull() & ~F.col(key).between(first, first + size - 1))
    return out.agg(
        F.count_distinct(key).alias("n_keys"),
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(value), F.lit(0)).cast("bigint").alias("total"),
    )


def widen(counts: DataFrame, key: str, value: str, columns: Mapping[int, str]) -> DataFrame:
    """Pivot per-device counts to one row per device, 0 where a key is absent.

    ``columns`` names consecutive keys; a key beyond them ends the run.

    ``counts`` holds one row per device and key, so a device has at most
    ``len(columns)`` rows that matter. Placing them by device first lets the pivot
    finish inside the partition: its wide buffers are never shuffled.
    """
    first, place = min(columns), F.col(key).cast("int")
    pivoted = (
        counts.select(
            "device_id", (placed_inside(place - first, len(columns), key) + first).alias(key), value
        )
        .repartition("device_id")
        .groupBy("device_id")
        .pivot(key, list(columns))
        .agg(F.sum(value))
    )
    names = list(columns.values())
    return pivoted.toDF("device_id", *names).fillna(0, names)


@dataclass(frozen=True)
class Block:
    """Per-device counts that fill a run of columns: key ``first`` fills the first name.

    Without a key there is one column, filled by the value itself.
    """

    counts: DataFrame
    value: str
    names: list[str]
    key: str | None = None
    first: int = 0

    def placed(self, offset: int, flag: int, kind: str = "bigint") -> DataFrame:
        """``(device_id, at, value, flag)``; a null key has a null place, one outside the names ends the run."""
        at = F.lit(0) if self.key is None else F.col(self.key) - self.first
        inside = placed_inside(at.cast("int"), len(self.names), self.key or self.value) + offset
        return self.counts.where(F.col(self.value).isNotNull()).select(
            "device_id",
            inside.cast("int").alias("at"),
            F.col(self.value).cast(kind).alias("value"),
            F.lit(flag).alias("flag"),
        )


def attach_blocks(attributes: DataFrame, *blocks: Block) -> DataFrame:
    """Attributes (one row per device) with the columns of all blocks.

    A column is 0 where the device has the block but not the key, and null
    throughout a block the device lacks. Attributes meet the counts while those are lists
    of places and values, and rows become wide a few devices at a time, so rows of a
    thousand columns are neither shuffled, sorted, aggregated nor joined. Adaptive execution sizes the partitions.
    """
    flags, offsets = _places(blocks)
    tall = reduce(
        DataFrame.unionByName, [b.placed(o, f) for b, o, f in zip(blocks, offsets, flags)]
    )
    return _widened(attributes, tall, [b.names for b in blocks], "bigint")


def attach_scaled_blocks(attributes: DataFrame, factors: DataFrame, *blocks: Block) -> DataFrame:
    """:func:`attach_blocks` with every column divided by its factor, null throughout where that is 0.

    Values are divided while they are long, so the wide step carries doubles and no number of
    ``factors`` comes to the driver. ``factors`` has one row for each name of a vocabulary (see
    ``scale_factors``), which bounds the broadcast; a column without a factor keeps its values.
    """
    flags, offsets = _places(blocks)
    names = [name for b in blocks for name in b.names]
    places = attributes.sparkSession.createDataFrame(list(enumerate(names)), "at int, feature string")
    known = places.join(F.broadcast(factors), "feature", "left").select("at", F.coalesce("factor", F.lit(1.0)).alias("factor"))
    tall = reduce(
        DataFrame.unionByName, [b.placed(o, f, "double") for b, o, f in zip(blocks, offsets, flags)]
    )
    scaled = tall.join(F.broadcast(known), "at", "left").select(
        "device_id", "at", F.try_divide("value", "factor").alias("value"), "flag"
    )
    wide = _widened(attributes, scaled, [b.names for b in blocks], "double")
    # one answer for each place, in order: whether its column is null throughout
    dead = known.agg(F.sort_array(F.collect_list(F.struct("at", (F.col("factor") == 0).alias("dead")))).alias("x"))
    wide = wide.withColumn("_dead", dead.select("x.dead").scalar())
    return wide.selectExpr(
        *[f"`{c}`" for c in attributes.columns], *[f"if(_dead[{i}], null, `{name}`) as `{name}`" for i, name in enumerate(names)]
    )


def _places(blocks: tuple[Block, ...]) -> tuple[list[int], list[int]]:
    """For each block, the position that marks its presence and that of its first column."""
    return [-1 - i for i in range(len(blocks))], [sum(len(b.names) for b in blocks[:i]) for i in range(len(blocks))]


def _gathered(tall: DataFrame, kind: str) -> DataFrame:
    """``device_id`` with the places, values and flags of its rows as three lists; devices follow each other in a sorted partition."""

    def rows(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        offsets = pa.array(np.append(starts, len(table)), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, c.combine_chunks()) for c in table.columns[1:]]
        return pa.RecordBatch.from_arrays([table.column(0).take(pa.array(starts)).combine_chunks(), *lists], names=["device_id", *CELLS])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = (table if held is None else pa.concat_tables([held, table])).combine_chunks()
            codes = table.column(0).chunk(0).dictionary_encode(null_encoding="encode").indices.to_numpy()
            starts = np.concatenate([[0], np.flatnonzero(np.diff(codes)) + 1])
            held = table.slice(starts[-1])
            if len(starts) > 1:
                yield rows(table.slice(0, starts[-1]), starts[:-1])
        if held is not None:
            yield rows(held, np.array([0]))

    number = T.LongType() if kind == "bigint" else T.DoubleType()
    schema = T.StructType([tall.schema["device_id"], *(T.StructField(c, T.ArrayType(t)) for c, t in zip(CELLS, (T.IntegerType(), number, T.IntegerType())))])
    return tall.repartition("device_id").sortWithinPartitions("device_id").mapInArrow(gather, schema)


def _widened(attributes: DataFrame, tall: DataFrame, names: list[list[str]], kind: str) -> DataFrame:
    """Distinct attributes with the columns of all blocks from ``(device_id, at, value, flag)``."""
    cells = _gathered(tall.where("device_id is not null"), kind).hint("merge")
    return _spread(attributes.distinct().join(cells, "device_id", "left").select(*attributes.columns, *CELLS), attributes, names, kind)


def _spread(rows: DataFrame, kept: DataFrame, names: list[list[str]], kind: str) -> DataFrame:
    """The columns of ``kept`` with those of all blocks, from lists of places, values and flags behind them; ``-1 - flag`` is the number of a block.

    Values of one place add up; a null place or value only shows that the block is there. ``WIDE_CELLS`` cells are wide at once.
    """
    sizes = [len(n) for n in names]
    bounds, width, number = np.cumsum([0, *sizes]), sum(sizes), np.dtype("int64" if kind == "bigint" else "float64")
    at_once, last, flat = max(1, WIDE_CELLS // max(1, width)), len(kept.columns), [n for own in names for n in own]
    outer = [*kept.columns, *flat]
    arrow = pa.int64() if kind == "bigint" else pa.float64()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, at_once):
                batch = whole.slice(first, at_once)
                n, lists = batch.num_rows, batch.columns[last:]
                row = np.repeat(np.arange(n), lists[0].value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                at, value, flag = (x.flatten() for x in lists)
                there = np.zeros((len(sizes), n), bool)
                there[-1 - flag.to_numpy(zero_copy_only=False), row] = True
                held = pc.and_(at.is_valid(), value.is_valid())
                row, at, value = row[held.to_numpy(zero_copy_only=False)], at.filter(held).to_numpy(), value.filter(held).to_numpy()
                # a column lies in a row, as Arrow wants it
                wide = np.zeros((width, n), number)
                np.add.at(wide, (at, row), value)
                buffer, columns = pa.py_buffer(wide), list(batch.columns[:last])
                for block, (low, high) in enumerate(zip(bounds, bounds[1:])):
                    gaps = n - int(there[block].sum())
                    valid = pa.py_buffer(np.packbits(there[block], bitorder="little")) if gaps else None
                    size = n * number.itemsize
                    columns += [pa.Array.from_buffers(arrow, n, [valid, buffer.slice(i * size, size)], gaps) for i in range(low, high)]
                yield pa.RecordBatch.from_arrays(columns, names=outer)

    schema = T.StructType([*kept.schema.fields, *(T.StructField(c, T.LongType() if kind == "bigint" else T.DoubleType()) for c in flat)])
    return rows.mapInArrow(work, schema)


def long_block(counts: DataFrame, block: Column, feature: Column, value: str) -> DataFrame:
    """Counts as ``(device_id, block, feature, value)``; rows without a key are no feature."""
    return counts.select(
        "device_id",
        block.alias("block"),
        feature.cast("string").alias("feature"),
        F.col(value).cast("double").alias("value"),
    ).where("feature is not null and value is not null")


def long_features(
    label_counts: DataFrame | None = None,
    slice_counts: DataFrame | None = None,
    totals: DataFrame | None = None,
    cluster_counts: DataFrame | None = None,
) -> DataFrame:
    """All given blocks stacked in long form; a zero is simply no row.

    Each total is a block of its own: a device may have one and miss the other.
    """
    parts = []
    if label_counts is not None:
        parts.append(long_block(label_counts, F.lit("labels"), F.col("label_id"), "ile"))
    if slice_counts is not None:
        name = F.concat(F.lit("t"), F.col("slice").cast("string"))
        parts.append(long_block(slice_counts, F.lit("time"), name, "c"))
    if totals is not None:
        tall = totals.unpivot("device_id", TOTALS, "name", "value")
        parts.append(long_block(tall, F.col("name"), F.col("name"), "value"))
    if cluster_counts is not None:
        name = F.concat(F.lit("c"), F.col("cluster").cast("string"))
        parts.append(long_block(cluster_counts, F.lit("clusters"), name, "n"))
    return reduce(DataFrame.unionByName, parts)


def vocabulary(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """Feature names as a frame; their number is a parameter, never the data's size."""
    return spark.createDataFrame([(n,) for n in names], "feature string")


# -- statistics ----------------------------------------------------------------


def block_sizes(long: DataFrame) -> DataFrame:
    """Devices that have each block; the others miss it and stay out of its statistics."""
    return long.groupBy("block").agg(F.count_distinct("device_id").alias("n"))


def feature_stats(long: DataFrame) -> DataFrame:
    """Minimum, maximum and mean per feature over the devices that have its block.

    Long form omits zeros, so a feature seen on fewer devices than its block has
    a zero somewhere: it bounds minimum and maximum and lowers the mean.
    """
    seen = long.groupBy("block", "feature").agg(
        F.count("value").alias("present"),
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
        F.sum("value").alias("total"),
    )
    gap = F.col("present") < F.col("n")
    zero = F.lit(0.0)
    return seen.join(block_sizes(long), "block").select(
        "feature",
        F.when(gap, F.least("lo", zero)).otherwise(F.col("lo")).alias("min"),
        F.when(gap, F.greatest("hi", zero)).otherwise(F.col("hi")).alias("max"),
        (F.col("total") / F.col("n")).alias("mean"),
    )


def constant_features(long: DataFrame, names: Iterable[str]) -> DataFrame:
    """Features of the vocabulary with one value everywhere; never seen means always 0."""
    stats = feature_stats(long)
    known = vocabulary(long.sparkSession, names)
    return (
        known.join(stats, "feature", "left")
        .select(
            "feature",
            F.coalesce("min", F.lit(0.0)).alias("value"),
            F.coalesce("max", F.lit(0.0)).alias("hi"),
        )
        .where("value = hi")
        .drop("hi")
    )


def drop_constant(long: DataFrame, constants: DataFrame) -> DataFrame:
    """Long form without the constant features (at most one row per vocabulary entry)."""
    names = F.broadcast(constants.select("feature"))
    return long.join(names, "feature", "left_anti").select(LONG)


# -- scaling -------------------------------------------------------------------


def scale_factors(names: Iterable[str], *sides: DataFrame) -> DataFrame:
    """Per feature the maximum over all sides, a third of it where that exceeds 3.

    The larger of the train and test maxima is the maximum over both, so the sides
    go through one aggregation. Restricted to the vocabulary: the result never has
    more rows than there are names.
    """
    values = reduce(DataFrame.unionByName, [s.select("feature", "value") for s in sides])
    seen = values.groupBy("feature").agg(F.max("value").alias("hi"))
    hi = F.greatest(F.coalesce("hi", F.lit(0.0)), F.lit(0.0))
    return (
        vocabulary(values.sparkSession, names)
        .join(seen, "feature", "left")
        .select("feature", F.when(hi > 3, hi / 3).otherwise(hi).alias("factor"))
    )


def apply_scale(long: DataFrame, factors: DataFrame) -> DataFrame:
    """Divide each value by its feature's factor; a zero factor gives null.

    A feature without a factor keeps its value.

    ``factors`` comes from a vocabulary (see ``scale_factors``), which bounds the
    broadcast; a feature that every device has therefore never becomes a hot join key.
    """
    divided = F.try_divide(F.col("value"), F.col("factor"))
    scaled = F.when(F.col("factor").isNull(), F.col("value")).otherwise(divided)
    joined = long.join(F.broadcast(factors), "feature", "left")
    return joined.select("device_id", "block", "feature", scaled.alias("value"))


def standardize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns to zero mean and unit sample variance; a constant column becomes 0."""
    packed = VectorAssembler(inputCols=columns, outputCol="_in").transform(df)
    scaler = StandardScaler(inputCol="_in", outputCol="_out", withMean=True, withStd=True)
    out = scaler.fit(packed).transform(packed).withColumn("_out", vector_to_array("_out"))
    return out.withColumns({c: F.col("_out")[i] for i, c in enumerate(columns)}).drop("_in", "_out")


def impute_mean(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing values of the columns replaced by the column mean."""
    df = df.withColumns({c: F.col(c).cast("double") for c in columns})
    return Imputer(strategy="mean", inputCols=columns, outputCols=columns).fit(df).transform(df)


# -- columns -------------------------------------------------------------------


def replace_columns(df: DataFrame, mapping: Mapping[str, Column | str]) -> DataFrame:
    """Overwrite or append columns; a string value renames that column to the key."""
    renames = {old: new for new, old in mapping.items() if isinstance(old, str)}
    values = {name: c for name, c in mapping.items() if not isinstance(c, str)}
    out = df.withColumns(values) if values else df
    out = out.drop(*[new for new in renames.values() if new in df.columns])
    return out.withColumnsRenamed(renames)


def category_indexer(columns: list[str]) -> StringIndexer:
    """Alphabetical codes; levels unseen in training and nulls share one extra code.

    The levels come to the driver: for columns of any number of levels see ``level_codes``.
    """
    return StringIndexer(
        inputCols=columns,
        outputCols=[f"{c}_idx" for c in columns],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )


def level_codes(df: DataFrame, column: str) -> DataFrame:
    """``(level, code)``: the distinct levels of a column and their places, from 0, in alphabetical order.

    Nulls have no code. Levels are dealt by range, so there may be any number of them.
    """
    levels = df.select(F.col(column).cast("string").alias("level")).where("level is not null").distinct()
    return numbered(levels, ["level"], "code").select("level", (F.col("code") - 1).cast("double").alias("code"))


def index_categories(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``{column}_idx`` codes learnt from ``df`` itself; nulls share the code behind the last level."""
    for column in columns:
        codes = materialize(level_codes(df, column)).withColumnRenamed("code", f"{column}_idx")
        beyond = codes.agg(F.coalesce(F.max(f"{column}_idx") + 1, F.lit(0.0))).scalar()
        key = f"_{column}_level"
        keyed = df.withColumn(key, F.col(column).cast("string"))
        joined = spread_join(keyed, codes.withColumnRenamed("level", key), key, "left", stable=df.columns)
        df = joined.drop(key).withColumn(f"{column}_idx", F.coalesce(f"{column}_idx", beyond))
    return df


def frequent_levels(df: DataFrame, column: str, limit: int) -> list[str] | None:
    """The ``limit`` most frequent levels of a column, ties by name; None where it has no more than that."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("level")).agg(F.count(F.lit(1)).alias("n"))
    rows = counts.orderBy(F.desc("n"), "level").limit(limit + 1).collect()
    return [r.level for r in rows[:limit]] if len(rows) > limit else None


def slotted(column: str, levels: list[str], slots: int) -> str:
    """SQL that keeps the given levels of a column and names the others by one of ``slots`` slots of a hash."""
    known = ", ".join(_literal(level) for level in levels)
    slot = f"concat('slot ', cast(pmod(xxhash64(cast(`{column}` as string)), {slots}) as string))"
    return f"CASE WHEN `{column}` IS NULL THEN NULL WHEN cast(`{column}` as string) IN ({known}) THEN cast(`{column}` as string) ELSE {slot} END"


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
