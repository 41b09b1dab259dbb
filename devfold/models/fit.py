"""Fitting: naive Bayes, random forest, perceptron, age regression, grid search."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, SQLTransformer, StandardScaler, VarianceThresholdSelector, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devfold.functions import hash_bucket
from devfold.models.network import NetworkModel, Training, train as train_network
from devfold.models.split import BUCKETS, hash_split
from devfold.operators.features import category_indexer, frequent_levels, slotted
from devfold.schemas import CLASSES, TOTALS, FeatureSpace
from devfold.session import materialize

MAX_DEPTH = 30  # deepest tree the library accepts
TASK_ROWS = 8192  # rows that a task of a perceptron's iteration reads
MOST_LEVELS, SLOTS = 2000, 200  # levels of a category with a code of their own, and codes that the rarer ones share


@dataclass(frozen=True)
class Inputs:
    """Which columns a model sees; whatever is not named is ignored."""

    blocks: tuple[str, ...] = ()
    numbers: tuple[str, ...] = ()
    categories: tuple[str, ...] = ("brand", "model")


# What each model looks at.
BASE_INPUTS = Inputs(("labels",))
FULL_INPUTS = Inputs(("labels", "time"))
EMPTY_INPUTS = Inputs()
ALL_INPUTS = Inputs(("labels", "time"), tuple(TOTALS))
PERSON_INPUTS = Inputs(("labels", "time", "clusters"), tuple(TOTALS))
STACKED_INPUTS = Inputs(PERSON_INPUTS.blocks, (*TOTALS, "age", "gender"))


@dataclass(frozen=True)
class Forest:
    trees: int
    depth: int
    bins: int = 32

    def __post_init__(self) -> None:
        if self.depth > MAX_DEPTH:
            raise ValueError(f"trees deeper than {MAX_DEPTH} are not supported: {self.depth}")


@dataclass(frozen=True)
class Network:
    hidden: tuple[int, ...]
    epochs: int


@dataclass(frozen=True)
class Stopping:
    """Rounds of ``every`` iterations, until ``patience`` rounds in a row bring no lower logloss on the held-out share."""

    every: int = 10
    patience: int = 42
    holdout: float = 0.1


# Model sizes by population. The forest of all devices is asked to go 40 deep
# elsewhere; 30 is what the library accepts, and anything beyond is refused, not cut.
FORESTS = {"base": Forest(500, 20), "empty": Forest(500, 15), "all": Forest(1500, MAX_DEPTH, 256)}
NETWORKS = {
    "full": Network((288, 144, 72, 36), 200),
    "empty": Network((576, 144, 72, 36), 200),
    "all": Network((64, 64, 64, 64, 64, 64), 500),
    "stacked": Network((32, 32, 32, 32, 32), 500),
    "person": Network((64, 64, 64), 500),
}


# How the networks of all devices, of the stacked group, of age and of gender are trained.
# Rates and steps are ours: a step here is the mean gradient of many rows.
TRAININGS = {
    "all": Training(500, hidden_dropout=0.05, l1=1e-3, l2=1e-3, most_squared=10.0, patience=42),
    "stacked": Training(500, activation="rectifier"),
    "person": Training(500, activation="rectifier"),
}


def with_label(
    df: DataFrame, target: str = "grp", classes: Sequence = CLASSES, label: str = "label"
) -> DataFrame:
    """Rows of a known class, with its position in ``classes`` as the label.

    The class list rides along as metadata, so a class absent from the training
    rows still gets its probability column.
    """
    names = [str(c) for c in classes]
    position = F.array_position(F.lit(names), F.col(target).cast("string")) - 1
    meta = {"ml_attr": {"type": "nominal", "name": label, "vals": names}}
    coded = df.withColumn(label, position.cast("double").alias(label, metadata=meta))
    return coded.where(F.col(label) >= 0)


def feature_stages(
    inputs: Inputs, one_hot: bool = True, scale: bool = False, drop_constant: bool = True, levels: Mapping[str, list[str]] | None = None
) -> list:
    """Imputing, coding and assembling of the inputs into ``features``.

    Entries of blocks and numbers that have one value in all training rows are no inputs; which ones is
    learnt with the pipeline and stored in it. Categories stay as they are; for those in ``levels`` only the levels
    named there have a code of their own, the others share ``SLOTS`` hashed ones.
    """
    stages: list = []
    parts = list(inputs.blocks)
    if inputs.numbers:
        filled = [f"{c}_num" for c in inputs.numbers]
        stages.append(Imputer(strategy="mean", inputCols=list(inputs.numbers), outputCols=filled))
        parts += filled
    if parts and drop_constant:
        stages.append(VectorAssembler(inputCols=parts, outputCol="all_features", handleInvalid="keep"))
        stages.append(VarianceThresholdSelector(featuresCol="all_features", outputCol="varying", varianceThreshold=0.0))
        parts = ["varying"]
    if inputs.categories:
        columns = list(inputs.categories)
        for column, known in (levels or {}).items():
            columns[columns.index(column)] = f"{column}_slot"
            stages.append(SQLTransformer(statement=f"SELECT *, {slotted(column, known, SLOTS)} AS `{column}_slot` FROM __THIS__"))
        codes = [f"{c}_idx" for c in columns]
        stages.append(category_indexer(columns))
        if one_hot:
            hot = [f"{c}_hot" for c in columns]
            stages.append(OneHotEncoder(inputCols=codes, outputCols=hot, dropLast=False))
            codes = hot
        parts += codes
    packed = "raw_features" if scale else "features"
    stages.append(VectorAssembler(inputCols=parts, outputCol=packed, handleInvalid="keep"))
    if scale:
        stages.append(
            StandardScaler(inputCol=packed, outputCol="features", withMean=True, withStd=True)
        )
    return stages


def _prepared(
    train: DataFrame, inputs: Inputs, one_hot: bool, scale: bool
) -> tuple[PipelineModel, DataFrame]:
    train = train.withColumns({c: F.col(c).cast("double") for c in inputs.numbers})
    levels = {c: found for c in inputs.categories if (found := frequent_levels(train, c, MOST_LEVELS)) is not None}
    prep = Pipeline(stages=feature_stages(inputs, one_hot, scale, levels=levels)).fit(train)
    return prep, prep.transform(train)


def _scaled(train: DataFrame, inputs: Inputs) -> tuple[PipelineModel, DataFrame]:
    """Standardised ``features`` and ``label``, over inputs that are written once before they are standardised.

    Rows are dealt by device to tasks of some ``TASK_ROWS``, so that every iteration of a fit keeps all cores busy.
    """
    train = train.withColumns({c: F.col(c).cast("double") for c in inputs.numbers})
    levels = {c: found for c in inputs.categories if (found := frequent_levels(train, c, MOST_LEVELS)) is not None}
    *stages, scaler = feature_stages(inputs, True, True, levels=levels)
    prep = Pipeline(stages=stages).fit(train)
    tasks = -(-train.count() // TASK_ROWS)
    rows = prep.transform(train).select("device_id", "label", scaler.getInputCol())
    if tasks > 1:
        rows = rows.repartition(tasks, "device_id").sortWithinPartitions("device_id")
    rows = materialize(rows)
    scaler = scaler.fit(rows)
    return PipelineModel([*prep.stages, scaler]), scaler.transform(rows)


def fit_network(
    train: DataFrame,
    inputs: Inputs = ALL_INPUTS,
    classes: Sequence = CLASSES,
    size: Network = NETWORKS["all"],
    seed: int = 0,
    target: str = "grp",
    how: Training = TRAININGS["all"],
    valid: DataFrame | None = None,
) -> PipelineModel:
    """Network with dropout and penalties on one output per class, stopped on the logloss of a held-out part.

    ``valid`` is that part; without it a hash of the device id takes a share of the training rows. The last stage
    keeps the loss of every epoch in ``curve``.
    """
    prep, ready = _prepared(with_label(train, target, classes), inputs, True, False)
    held = None
    if valid is not None:
        held = prep.transform(with_label(valid, target, classes).withColumns({c: F.col(c).cast("double") for c in inputs.numbers}))
    found = train_network(ready, "label", "device_id", size.hidden, len(classes), "classes", replace(how, epochs=size.epochs), seed, held)
    return PipelineModel([*prep.stages, NetworkModel.of(found)])


def fit_gender_network(
    train: DataFrame, inputs: Inputs = PERSON_INPUTS, size: Network = NETWORKS["person"], seed: int = 0, how: Training = TRAININGS["person"]
) -> PipelineModel:
    """Two-class network on the gender code."""
    return fit_network(train, inputs, [0, 1], size, seed, "gender", how)


def fit_age_network(
    train: DataFrame, inputs: Inputs = PERSON_INPUTS, size: Network = NETWORKS["person"], seed: int = 0, how: Training = TRAININGS["person"]
) -> PipelineModel:
    """Network on the age, by squared error, stopped when a held-out part gains no more. Devices of unknown age take no part."""
    known = train.where("age is not null")
    middle, spread = known.agg(F.avg("age"), F.stddev_samp("age")).head()
    if middle is None:
        raise ValueError("no device has an age")
    unit = float(spread) if spread else 1.0
    prep, ready = _prepared(known.withColumn("age_label", (F.col("age") - middle) / unit), inputs, True, False)
    found = train_network(ready, "age_label", "device_id", size.hidden, 1, "number", replace(how, epochs=size.epochs), seed)
    return PipelineModel([*prep.stages, NetworkModel.of(found, "age_prediction", unit, float(middle))])


def loss_curve(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``(epoch, train_loss, valid_loss)`` of a network as it was fitted, each loss of the weights its epoch starts with."""
    return df.sparkSession.createDataFrame(model.stages[-1].curve, "epoch int, train_loss double, valid_loss double")


def _width(df: DataFrame) -> int:
    """Number of inputs, as the assembler's column metadata has it; no job is run."""
    return df.schema["features"].metadata["ml_attr"]["num_attrs"]


class ClassPlaces(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Gives every class its place in ``probability`` and ``prediction``, after a model that knows only some of them.

    ``places`` has, for each class, its number in the model, or -1 for a class the model never saw, whose probability is 0.
    """

    places = Param(Params._dummy(), "places", "number of each class in the model", TypeConverters.toListInt)

    @keyword_only
    def __init__(self, *, places: list[int] | None = None) -> None:
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        places = self.getOrDefault("places")
        known = sorted(range(len(places)), key=lambda i: places[i])[-sum(p >= 0 for p in places) :]
        found = vector_to_array("probability")
        spread = F.array(*[F.get(found, F.lit(p)) if p >= 0 else F.lit(0.0) for p in places])
        prediction = F.get(F.lit([float(i) for i in known]), F.col("prediction").cast("int"))
        return df.withColumns({"probability": array_to_vector(spread), "prediction": prediction})


def fit_naive_bayes(
    train: DataFrame, inputs: Inputs = BASE_INPUTS, classes: Sequence = CLASSES
) -> PipelineModel:
    """Gaussian naive Bayes on the group. A class without a training row has probability 0."""
    names = [str(c) for c in classes]
    seen = {r[0] for r in train.select(F.col("grp").cast("string")).where(F.col("grp").isin(names)).distinct().collect()}
    known = [c for c in names if c in seen]
    prep, ready = _prepared(with_label(train, classes=known), inputs, True, False)
    stages = [*prep.stages, NaiveBayes(modelType="gaussian").fit(ready)]
    if len(known) < len(names):
        stages.append(ClassPlaces(places=[known.index(c) if c in seen else -1 for c in names]))
    return PipelineModel(stages)


def _forest(prep: PipelineModel, size: Forest, seed: int, **params: object) -> RandomForestClassifier:
    levels = [len(v) + 1 for s in prep.stages if hasattr(s, "labelsArray") for v in s.labelsArray]
    return RandomForestClassifier(
        numTrees=size.trees,
        maxDepth=size.depth,
        maxBins=max([size.bins, *levels]),
        seed=seed,
        **params,
    )


def fit_forest(
    train: DataFrame,
    inputs: Inputs = ALL_INPUTS,
    classes: Sequence = CLASSES,
    size: Forest = FORESTS["all"],
    seed: int = 0,
) -> PipelineModel:
    """Random forest on the group; categories enter as codes, one bin per level."""
    prep, ready = _prepared(with_label(train, classes=classes), inputs, False, False)
    return PipelineModel(prep.stages + [_forest(prep, size, seed).fit(ready)])


def fit_mlp(
    train: DataFrame,
    inputs: Inputs = ALL_INPUTS,
    classes: Sequence = CLASSES,
    size: Network = NETWORKS["all"],
    seed: int = 0,
    target: str = "grp",
    stopping: Stopping | None = None,
) -> PipelineModel:
    """Perceptron on standardised inputs, one output per class.

    With ``stopping`` the fit goes on in rounds, each from the weights of the one before, and the
    round with the lowest logloss on a held-out part counts.
    """
    labelled = with_label(train, target, classes)
    if stopping is None:
        prep, ready = _scaled(labelled, inputs)
        layers = [_width(ready), *size.hidden, len(classes)]
        net = MultilayerPerceptronClassifier(layers=layers, maxIter=size.epochs, seed=seed)
        return PipelineModel(prep.stages + [net.fit(ready)])
    known, held = hash_split(labelled, 1 - stopping.holdout, seed)
    prep, ready = _prepared(known, inputs, True, True)
    valid = prep.transform(held.withColumns({c: F.col(c).cast("double") for c in inputs.numbers}))
    ready, valid = (materialize(df.select("features", "label")) for df in (ready, valid))
    layers = [_width(ready), *size.hidden, len(classes)]
    judge = MulticlassClassificationEvaluator(metricName="logLoss")
    best, lowest, waited, weights, curve = None, float("inf"), 0, None, []
    for done in range(0, size.epochs, stopping.every):
        net = MultilayerPerceptronClassifier(layers=layers, maxIter=min(stopping.every, size.epochs - done), seed=seed)
        if weights is not None:
            net.setInitialWeights(weights)
        model = net.fit(ready)
        weights, loss = model.weights, judge.evaluate(model.transform(valid))
        curve.append((done + net.getMaxIter(), None, float(loss)))
        if loss < lowest:
            best, lowest, waited = model, loss, 0
        else:
            waited += 1
            if waited >= stopping.patience:
                break
    best.curve = curve
    return PipelineModel([*prep.stages, best])


def fit_gender(
    train: DataFrame,
    inputs: Inputs = PERSON_INPUTS,
    size: Network = NETWORKS["person"],
    seed: int = 0,
) -> PipelineModel:
    """Two-class perceptron on the gender code."""
    return fit_mlp(train, inputs, [0, 1], size, seed, target="gender")


def fit_age(
    train: DataFrame,
    inputs: Inputs = PERSON_INPUTS,
    trees: int = 50,
    depth: int = 5,
    seed: int = 0,
    holdout: float = 0.1,
) -> PipelineModel:
    """Boosted regression of the age.

    The number of trees is that at which held-out devices gain no more; the model is then fitted anew on all.
    """
    known = train.where("age is not null").withColumns(
        {
            "age_label": F.col("age").cast("double"),
            "held_out": hash_bucket("device_id", BUCKETS, seed) < round(holdout * BUCKETS),
        }
    )
    prep, ready = _prepared(known, inputs, False, False)
    levels = [len(v) + 1 for s in prep.stages if hasattr(s, "labelsArray") for v in s.labelsArray]
    booster = GBTRegressor(
        labelCol="age_label",
        predictionCol="age_prediction",
        maxIter=trees,
        maxDepth=depth,
        maxBins=max([32, *levels]),
        seed=seed,
    )
    found = booster.fit(ready, {booster.validationIndicatorCol: "held_out"})
    return PipelineModel(prep.stages + [booster.fit(ready, {booster.maxIter: found.getNumTrees})])


def grid_search(
    train: DataFrame,
    inputs: Inputs = ALL_INPUTS,
    classes: Sequence = CLASSES,
    trees: Sequence[int] = (20, 50),
    depths: Sequence[int] = (5, 10),
    seed: int = 0,
    parallelism: int = 2,
) -> DataFrame:
    """Logloss of every forest size on a held-out tenth, best first."""
    known, held = hash_split(with_label(train, classes=classes), 0.9, seed)
    prep, ready = _prepared(known, inputs, False, False)
    valid = prep.transform(held.withColumns({c: F.col(c).cast("double") for c in inputs.numbers}))
    judge = MulticlassClassificationEvaluator(metricName="logLoss")
    sizes = [Forest(t, d) for t in trees for d in depths]
    ready, valid = (materialize(df.select("features", "label")) for df in (ready, valid))

    def loss(size: Forest) -> float:
        return judge.evaluate(_forest(prep, size, seed).fit(ready).transform(valid))

    with ThreadPoolExecutor(parallelism) as pool:
        rows = [(s.trees, s.depth, float(v)) for s, v in zip(sizes, pool.map(loss, sizes))]
    schema = "trees int, depth int, logloss double"
    return train.sparkSession.createDataFrame(rows, schema).orderBy("logloss", "trees", "depth")


def halving_search(
    train: DataFrame,
    settings: Sequence[tuple[Network, Training]],
    inputs: Inputs = ALL_INPUTS,
    classes: Sequence = CLASSES,
    seed: int = 0,
    first: int = 10,
    holdout: float = 0.1,
) -> tuple[PipelineModel, DataFrame]:
    """The best of several networks, fitted on all rows, and a table of what each setting reached.

    Every setting is fitted for ``first`` epochs; the better half by logloss on the held-out share goes on from its weights
    for twice as many, until one is left or all have run their epochs. The winner is then fitted anew on all
    rows for as many epochs as its best weights had behind them. The table has one row for each setting and round:
    ``(setting, round, epochs, logloss)``, where ``setting`` is the place in ``settings``.
    """
    if not settings:
        raise ValueError("no setting to choose from")
    known, held = hash_split(with_label(train, classes=classes), 1 - holdout, seed)
    prep, ready = _prepared(known, inputs, True, False)
    numbers = {c: F.col(c).cast("double") for c in inputs.numbers}
    ready, valid = (materialize(df.select("device_id", "features", "label")) for df in (ready, prep.transform(held.withColumns(numbers))))
    state: dict[int, tuple[np.ndarray | None, int]] = {i: (None, 0) for i in range(len(settings))}
    best = {i: (float("inf"), 0) for i in state}
    rows, turn, more = [], 0, first
    while True:
        for i in list(state):
            (size, how), (weights, done) = settings[i], state[i]
            epochs = min(more, size.epochs - done)
            found = train_network(
                ready, "label", "device_id", size.hidden, len(classes), "classes", replace(how, epochs=epochs, patience=None), seed + done, valid, weights
            )
            at, loss = min(((e, v) for e, _, v in found.curve), key=lambda x: x[1])
            state[i] = (found.weights, done + at)
            best[i] = min(best[i], (loss, done + at))
            rows.append((i, turn, done + at, float(best[i][0])))
        order = sorted(state, key=lambda i: (best[i][0], i))
        if len(order) == 1 or all(state[i][1] >= settings[i][0].epochs for i in order):
            break
        state = {i: state[i] for i in order[: max(1, len(order) // 2)]}
        turn, more = turn + 1, 2 * more
    winner = order[0]
    size, how = settings[winner]
    final = replace(how, patience=None, holdout=0.0)
    model = fit_network(train, inputs, classes, replace(size, epochs=max(1, best[winner][1])), seed, how=final)
    return model, train.sparkSession.createDataFrame(rows, "setting int, round int, epochs int, logloss double")


def input_names(inputs: Inputs, space: FeatureSpace) -> list[str]:
    """Names of the inputs in the order they are assembled."""
    blocks = {"labels": space.label_names, "time": space.slice_names, "clusters": space.cluster_names}
    names = [n for b in inputs.blocks for n in blocks[b]]
    return names + list(inputs.numbers) + list(inputs.categories)


def fitted_names(model: PipelineModel, inputs: Inputs, space: FeatureSpace) -> list[str]:
    """Names of the inputs that a fitted pipeline kept, in the order they are assembled."""
    names = input_names(inputs, space)
    for stage in model.stages:
        if hasattr(stage, "selectedFeatures"):
            categories = names[len(names) - len(inputs.categories) :]
            names = [names[i] for i in stage.selectedFeatures] + categories
    return names


def importances(
    model: PipelineModel, inputs: Inputs, space: FeatureSpace, df: DataFrame
) -> DataFrame:
    """Importance per feature of a fitted forest, largest first; 0 for inputs left out as constant."""
    scores = model.stages[-1].featureImportances.toArray().tolist()
    known = dict(zip(fitted_names(model, inputs, space), scores, strict=True))
    rows = [(name, known.get(name, 0.0)) for name in input_names(inputs, space)]
    frame = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return frame.orderBy(F.desc("importance"), "feature")


def network_importances(
    model: PipelineModel, inputs: Inputs, space: FeatureSpace, df: DataFrame
) -> DataFrame:
    """Importance per feature of a fitted network, scaled to a largest of 1; 0 for inputs left out as constant.

    A feature's share of the absolute weights into each unit is passed on through the
    first two layers; the levels of a category add up to one entry.
    """
    net = model.stages[-1]
    sizes, flat = net.getLayers(), np.asarray(net.weights)
    first, second, at = None, None, 0
    for wide, narrow in zip(sizes, sizes[1:3]):
        layer = np.abs(flat[at : at + wide * narrow].reshape(wide, narrow))
        at += wide * narrow + narrow
        shares = layer / np.maximum(layer.sum(axis=0), 1e-300)
        first, second = (shares, None) if first is None else (first, shares)
    scores = (first @ second).sum(axis=1) if second is not None else first.sum(axis=1)
    levels = {c: len(v) + 1 for s in model.stages if hasattr(s, "labelsArray")
              for c, v in zip(inputs.categories, s.labelsArray)}
    names = [n for n in fitted_names(model, inputs, space) for _ in range(levels.get(n, 1))]
    left_out = [(n, 0.0) for n in input_names(inputs, space) if n not in set(names)]
    frame = df.sparkSession.createDataFrame(
        [(n, float(v)) for n, v in zip(names, scores, strict=True)] + left_out,
        "feature string, importance double",
    ).groupBy("feature").agg(F.sum("importance").alias("importance"))
    largest = frame.agg(F.max("importance")).scalar()
    return frame.select("feature", F.try_divide("importance", largest).alias("importance")).orderBy(
        F.desc("importance"), "feature"
    )
