"""Equi-join that stays balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_KEYS = 256
TRACKED_KEYS = 4096
SKETCH_GROUPS = 256
SALTS = 32


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst's size estimate for ``df`` is within the broadcast threshold.

    A client without access to the plan (a remote session) counts as not fitting.
    """
    try:
        limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except AttributeError:
        return False
    return int(str(size)) <= limit


def hot_keys(df: DataFrame, key: str) -> Column:
    """The most frequent keys as an array of at most ``HOT_KEYS`` entries.

    One pass over a single column builds fixed-size sketches, merged in
    ``SKETCH_GROUPS`` groups; the best of each group are then added up. A key named
    without need is harmless to salt. A key with a share above about 1 in
    ``TRACKED_KEYS`` is not missed unless ``HOT_KEYS`` others are hotter; what lies
    below that is left to the runtime splitting of skewed join partitions.
    """
    slot = (F.spark_partition_id() % SKETCH_GROUPS).alias("slot")
    top = F.expr(f"approx_top_k(`{key}`, {HOT_KEYS}, {TRACKED_KEYS})")
    per_slot = df.select(key, slot).groupBy("slot").agg(top.alias("top"))
    best = (
        per_slot.select(F.inline("top"))
        .groupBy("item")
        .agg(F.sum("count").alias("total"))
        .orderBy(F.desc("total"), "item")
        .limit(HOT_KEYS)
    )
    return best.agg(F.collect_list("item")).scalar()


def spread_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    how: str = "inner",
    sample: DataFrame | None = None,
    salts: int = SALTS,
    stable: list[str] | None = None,
) -> DataFrame:
    """``big`` joined to ``small`` on ``key``, exact for any key distribution.

    A small side within the broadcast threshold needs no shuffle, so no key can be
    hot. Beyond it, rows of hot keys are dealt over ``salts`` partitions by a hash
    of the whole row and only the matching rows of ``small`` are repeated; all
    other rows keep a plain hash join. A null key matches nothing, so its rows are
    dealt the same way without any copy. ``sample`` may name a cheaper frame with the
    same key distribution (such as the raw table under ``big``). ``stable`` names the
    columns whose hash deals the rows, where ``big`` has others that a retry may change.

    A hot 64-bit key and its salt meet as one hash, the others as they are, since Spark sorts by one number several times
    faster than by two columns; rows of different keys that meet are told apart by the keys themselves.
    """
    if how not in ("inner", "left"):
        raise ValueError("only joins that keep the big side whole: inner, left")
    if fits_broadcast(small):
        return big.join(small, key, how)
    hot = hot_keys(big if sample is None else sample, key)
    is_hot = F.array_contains(hot, F.col(key))
    row_hash = F.pmod(F.xxhash64(*(stable or big.columns)), F.lit(salts)).cast("int")
    dealt = F.when(is_hot | F.col(key).isNull(), row_hash)
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1)))
    left = big.withColumn("_salt", F.coalesce(dealt, F.lit(0)))
    if how == "inner":
        left = left.where(F.col(key).isNotNull())
    right = small.withColumn("_salt", F.explode(F.coalesce(copies, F.array(F.lit(0)))))
    if not big.schema[key].dataType == small.schema[key].dataType == T.LongType():
        return left.join(right, [key, "_salt"], how).drop("_salt")
    spread = F.xxhash64(key, "_salt")
    left = left.select(key, *[c for c in big.columns if c != key], F.when(dealt.isNull(), F.col(key)).otherwise(spread).alias("_salted"))
    right = right.withColumns({"_salted_too": F.when(is_hot, spread).otherwise(F.col(key))}).withColumnRenamed(key, "_key").drop("_salt")
    # as a range: an equality would become a second column to sort by
    same = (F.col("_salted") == F.col("_salted_too")) & F.col(key).between(F.col("_key"), F.col("_key"))
    return left.join(right, same, how).drop("_salted", "_salted_too", "_key")
