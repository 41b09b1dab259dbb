"""Two-stage model: predicted age and gender become inputs of the group model."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devfold.models.fit import (
    NETWORKS,
    STACKED_INPUTS,
    Network,
    fit_age_network,
    fit_gender_network,
    fit_mlp,
)
from devfold.models.split import with_fold
from devfold.schemas import CLASSES
from devfold.session import materialize


@dataclass(frozen=True)
class StackedModel:
    age: PipelineModel
    gender: PipelineModel
    group: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        return self.group.transform(_casted(replace_person(df, self.age, self.gender)))

    def save(self, path: str) -> None:
        for name in ("age", "gender", "group"):
            getattr(self, name).write().overwrite().save(f"{path}/{name}")

    @staticmethod
    def load(path: str) -> StackedModel:
        return StackedModel(
            *(PipelineModel.load(f"{path}/{name}") for name in ("age", "gender", "group"))
        )


def replace_person(df: DataFrame, age: PipelineModel, gender: PipelineModel) -> DataFrame:
    """Overwrite ``age`` and ``gender`` with the predictions of the first stage."""
    kept = [c for c in df.columns if c not in ("age", "gender")]
    aged = age.transform(_casted(df)).select(*df.columns, "age_prediction")
    done = gender.transform(_casted(aged))
    return done.select(
        *kept,
        F.col("age_prediction").alias("age"),
        F.col("prediction").alias("gender"),
    )


def _casted(df: DataFrame) -> DataFrame:
    numbers = [c for c in ("allev", "nolat", "age", "gender") if c in df.columns]
    return df.withColumns({c: F.col(c).cast("double") for c in numbers})


def fit_stacked(
    train: DataFrame,
    classes: Sequence = CLASSES,
    folds: int = 3,
    seed: int = 0,
    size: Network = NETWORKS["stacked"],
    age_fit: Callable[[DataFrame], PipelineModel] = fit_age_network,
    gender_fit: Callable[[DataFrame], PipelineModel] = fit_gender_network,
) -> StackedModel:
    """Fit both stages.

    Training rows get their first-stage predictions from models that never saw
    them: each fold is scored by a fit on the other folds. New devices are scored
    by fits on all rows. ``age_fit`` may be any fit that adds ``age_prediction``, such as the boosted trees of ``fit_age``.
    """
    parts = with_fold(train, folds, seed)
    scored = []
    for fold in range(folds):
        rest = parts.where(F.col("fold") != fold).drop("fold")
        held = parts.where(F.col("fold") == fold).drop("fold")
        scored.append(replace_person(held, age_fit(rest), gender_fit(rest)))
    stacked = materialize(reduce(DataFrame.unionByName, scored))
    group = fit_mlp(stacked, STACKED_INPUTS, classes, size, seed)
    return StackedModel(age_fit(train), gender_fit(train), group)
