"""First-stage and second-stage models on Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import FMClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nextpick.defaults import SEED
from nextpick.sources.stage import stage


def _with_zero(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    # Feature vectors take no nulls; the reference point of scaled columns is 0.
    return frame.na.fill(0, list(columns))


def fit_first_stage(train: DataFrame, sparse: Sequence[str], dense: Sequence[str], factors: int = 8,
                    iterations: int = 20, seed: int = SEED) -> PipelineModel:
    """Factorization machine on one-hot `sparse` codes and `dense` numbers.

    Target category and customer features meet in the pairwise factors. Codes not seen in
    training fall into an extra slot.
    """
    hot = [f"{c}_hot" for c in sparse]
    steps = [OneHotEncoder(inputCols=list(sparse), outputCols=hot, handleInvalid="keep", dropLast=False),
             VectorAssembler(inputCols=hot + list(dense), outputCol="features"),
             FMClassifier(labelCol="target", factorSize=factors, maxIter=iterations, stepSize=0.05, seed=seed)]
    return Pipeline(stages=steps).fit(_with_zero(train, [*sparse, *dense]))


def score(candidates: DataFrame, model: PipelineModel, filled: Sequence[str]) -> DataFrame:
    """Add ``score``, the model's probability of class 1."""
    scored = model.transform(_with_zero(candidates, filled))
    return scored.withColumn("score", vector_to_array("probability")[1]).select(*candidates.columns, "score")


def score_with(candidates: DataFrame, predict: Callable, inputs: Sequence[str]) -> DataFrame:
    """Add ``score`` from a foreign model: `predict` takes a pandas frame of `inputs`.

    Batches go to Python through Arrow, as many tasks at a time as the input has partitions.
    """
    def run(batches: Iterator):
        for batch in batches:
            yield batch.assign(score=predict(batch[list(inputs)]))

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in candidates.schema.fields)
    return candidates.mapInPandas(run, f"{names}, score double")


def fit_multi_class(train: DataFrame, inputs: Sequence[str], trees: int = 20, depth: int = 5,
                    seed: int = SEED) -> PipelineModel:
    """Second stage as one multiclass forest on ``label``."""
    steps = [VectorAssembler(inputCols=list(inputs), outputCol="features"),
             RandomForestClassifier(labelCol="label", numTrees=trees, maxDepth=depth, seed=seed)]
    return Pipeline(stages=steps).fit(_with_zero(train, inputs))


def predict_class(frame: DataFrame, model: PipelineModel, inputs: Sequence[str]) -> DataFrame:
    """(customer_id, pred_class) from the multiclass model."""
    predicted = model.transform(_with_zero(frame, inputs))
    return predicted.select("customer_id", F.col("prediction").cast("int").alias("pred_class"))


def fit_chain(train: DataFrame, inputs: Sequence[str], codes: Sequence[int], iterations: int = 5,
              depth: int = 3, seed: int = SEED, parallel: int = 8) -> list[PipelineModel]:
    """Second stage as a chain: the model of each label also sees the labels before it.

    In training these are the true labels, so no link waits for another: `parallel` fits at a
    time share the cluster, all on one staged table of the columns they need.
    """
    names = [f"label_{code}" for code in codes]
    train = stage(_with_zero(train, [*inputs, *names]).select(*inputs, *names), "chain-input")

    def fit(place: int) -> PipelineModel:
        steps = [VectorAssembler(inputCols=[*inputs, *names[:place]], outputCol="features"),
                 GBTClassifier(labelCol=names[place], maxIter=iterations, maxDepth=depth, seed=seed)]
        return Pipeline(stages=steps).fit(train)

    with ThreadPoolExecutor(max(1, min(parallel, len(codes)))) as pool:
        return list(pool.map(inheritable_thread_target(train.sparkSession)(fit), range(len(codes))))


def predict_chain(frame: DataFrame, chain: Sequence[PipelineModel], inputs: Sequence[str], codes: Sequence[int],
                  links_per_stage: int = 4) -> DataFrame:
    """(customer_id, prob_<code> ...): each link sees the predictions made before it.

    Every few links the result is staged, since the plan of a link holds all plans before it.
    """
    result = _with_zero(frame.select("customer_id", *inputs), inputs)
    for place, (code, model) in enumerate(zip(codes, chain), 1):
        result = (model.transform(result)
                  .withColumn(f"prob_{code}", vector_to_array("probability")[1])
                  .withColumn(f"label_{code}", F.col("prediction"))
                  .drop("features", "rawPrediction", "probability", "prediction"))
        if place % links_per_stage == 0:
            result = stage(result, "chain")
    return result.select("customer_id", *[f"prob_{code}" for code in codes])
