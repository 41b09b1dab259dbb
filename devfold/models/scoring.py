"""Class probabilities per device, the class-prior baseline, and quality figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devfold.models.stacking import StackedModel, _casted
from devfold.operators.features import vocabulary
from devfold.schemas import CLASSES

FLOOR = 1e-15  # probabilities below this count as this in the logloss


def submission(
    model: PipelineModel | StackedModel,
    test: DataFrame,
    classes: Sequence[str] = CLASSES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Device id and one probability per class, in class order."""
    scored = model.transform(_casted(test)).withColumn("_p", vector_to_array("probability"))
    return scored.select(
        "device_id", *keep, *[F.col("_p")[i].alias(c) for i, c in enumerate(classes)]
    )


def class_frequencies(
    train: DataFrame, by: str = "brand", classes: Sequence[str] = CLASSES
) -> DataFrame:
    """Share of each class among the labelled devices of each brand."""
    known = train.where(F.col("grp").isNotNull())
    shares = [_share(c).alias(c) for c in classes]
    return known.groupBy(by).agg(*shares)


def _share(name: str) -> Column:
    hits = F.count_if(F.col("grp") == name)
    return hits.cast("double") / F.count(F.lit(1)).cast("double")


def prior_submission(
    train: DataFrame,
    test: DataFrame,
    by: str = "brand",
    classes: Sequence[str] = CLASSES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Class frequencies of the device's brand; overall frequencies for an unseen brand.

    The joined side has one row per brand; adaptive execution broadcasts it once its
    real size is known, and splits a hot brand otherwise.
    """
    known = train.where(F.col("grp").isNotNull())
    overall = known.agg(F.struct(*[_share(c).alias(c) for c in classes])).scalar()
    joined = test.join(class_frequencies(train, by, classes), by, "left")
    return joined.select(
        "device_id",
        *keep,
        *[F.coalesce(F.col(f"`{c}`"), overall.getField(c)).alias(c) for c in classes],
    )


def evaluate(
    scored: DataFrame, target: str = "grp", classes: Sequence[str] = CLASSES
) -> DataFrame:
    """Logloss, mean squared error of the true class's probability, and R² as one row.

    R² compares that error with the variance of the class number.
    """
    of_class = [F.when(F.col(target) == c, F.col(f"`{c}`")) for c in classes]
    number = F.array_position(F.lit(list(classes)), F.col(target)) - 1
    rated = scored.select(F.coalesce(*of_class).alias("p"), number.alias("y")).where("p is not null")
    loss = -F.ln(F.greatest(F.col("p"), F.lit(FLOOR)))
    error = F.avg((1 - F.col("p")) * (1 - F.col("p")))
    return rated.agg(
        F.count("p").alias("n"),
        F.avg(loss).alias("logloss"),
        error.alias("mse"),
        (1 - F.try_divide(error, F.var_samp("y"))).alias("r2"),
    )


def class_stats(long: DataFrame, devices: DataFrame, names: Sequence[str]) -> DataFrame:
    """Devices, mean and variance per class and feature: what Gaussian naive Bayes learns.

    One row for every class and every name of the vocabulary. Within a block an absent
    feature is 0; a labelled device without the block counts with the block's mean over
    the labelled devices that have it, as the fitted models see it.
    """
    spark = long.sparkSession
    known = devices.where("grp is not null").select("device_id", "grp")
    sizes = known.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    labelled = long.join(known, "device_id")
    held = labelled.select("device_id", "grp", "block").distinct().groupBy("grp", "block").agg(F.count(F.lit(1)).alias("held"))
    sums = labelled.groupBy("grp", "block", "feature").agg(
        F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("ss")
    )
    have = held.groupBy("block").agg(F.sum("held").alias("have"))
    overall = sums.groupBy("block", "feature").agg(F.sum("s").alias("t")).join(have, "block")
    centre = overall.select("feature", "block", (F.col("t") / F.col("have")).alias("centre"))
    named = vocabulary(spark, names).join(centre, "feature", "left")
    grid = sizes.select("grp", "n", F.explode(F.lit(list(names))).alias("feature")).join(named, "feature")
    full = grid.join(held, ["grp", "block"], "left").join(sums, ["grp", "block", "feature"], "left")
    missing = F.when(F.col("block").isNull(), 0).otherwise(F.col("n") - F.coalesce("held", F.lit(0)))
    mid = F.coalesce("centre", F.lit(0.0))
    mean = (F.coalesce("s", F.lit(0.0)) + missing * mid) / F.col("n")
    square = (F.coalesce("ss", F.lit(0.0)) + missing * mid * mid) / F.col("n")
    return full.select("grp", "feature", "n", mean.alias("mean"), (square - mean * mean).alias("variance"))
