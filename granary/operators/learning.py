"""The baseline classifiers: features scaled by their deviation, and linear models of the classes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IndexToString, StandardScaler, StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.lineage import cut


def train_baseline(rows: DataFrame, rounds: int = 2000, ridge: float = 1e-4) -> PipelineModel:
    """A model from rows (features: array, label: text). Features are divided by their deviation, not moved, so that
    zeros stay zeros; classes are told apart by logistic regression. Rows without features or label are left out."""
    usable = rows.where(F.col("features").isNotNull() & F.col("label").isNotNull()).withColumn("vector", array_to_vector("features"))
    index = StringIndexer(inputCol="label", outputCol="class", stringOrderType="alphabetAsc").fit(usable)
    stages = [
        index, StandardScaler(inputCol="vector", outputCol="scaled", withMean=False, withStd=True),
        LogisticRegression(featuresCol="scaled", labelCol="class", maxIter=rounds, regParam=ridge, standardization=False),
        IndexToString(inputCol="prediction", outputCol="predicted", labels=index.labels),
    ]
    return Pipeline(stages=stages).fit(usable)


def predicted(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """rows with ``predicted``; a label that the model doesn't know is no hindrance. (truth, predicted) go to ``metrics``."""
    some = rows.where(F.col("features").isNotNull()).withColumn("vector", array_to_vector("features"))
    for stage in model.stages[1:]:
        some = stage.transform(some)
    return some.select(*rows.columns, "predicted")


# --- stochastic steps on the logistic loss -----------------------------------------------------------------------------

#: Rows of a block, which one task works through in order.
BLOCK_ROWS = 4096


@dataclass
class Linear:
    """One linear model a class (one against the rest); features are divided by ``scale``."""

    classes: list[str]
    weights: np.ndarray  # a row a class, the bias last
    scale: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        return (features / self.scale) @ self.weights[:, :-1].T + self.weights[:, -1]


def stochastic_steps(weights: np.ndarray, x: np.ndarray, y: np.ndarray, first: int, ridge: float, rate: float, power: float) -> np.ndarray:
    """The weights after a step for each row: all classes at once, at a rate of rate / (1 + step) ** power; first: steps before."""
    weights = weights.copy()
    classes = np.arange(len(weights))
    for i, row in enumerate(x):
        pace = rate / (1 + first + i) ** power
        miss = 1 / (1 + np.exp(-np.clip(weights[:, :-1] @ row + weights[:, -1], -30, 30))) - (classes == y[i])
        weights[:, :-1] = weights[:, :-1] * (1 - pace * ridge) - pace * miss[:, None] * row
        weights[:, -1] -= pace * miss
    return weights


def train_stochastic(rows: DataFrame, id_column: str, epochs: int = 20, ridge: float = 1e-5, rate: float = 0.5, power: float = 0.25, seed: int = 42, block_rows: int = BLOCK_ROWS) -> Linear:
    """A linear model from rows (id, features: array of one length, label) by stochastic steps on the logistic loss.

    Features are divided by their deviation (1 where it is 0), not moved. Rows lie in blocks, about ``block_rows`` each,
    and in the order of a seeded hash of the id inside of them; in each epoch every block steps through its rows from the
    common weights, and the blocks' weights are averaged by their rows. So the model depends on ids and seed, not on
    partitions. Sums are formed in tasks before they are added up; classes and weights come to the driver. Rows without
    features or label are left out. No rows: no classes.
    """
    usable = rows.where(F.col("features").isNotNull() & F.col("label").isNotNull()).select(F.col(id_column).cast("string").alias("id"), "features", F.col("label").cast("string").alias("label"))
    classes = sorted(r["label"] for r in usable.select("label").distinct().collect())  # a row a class
    if not classes:
        return Linear([], np.zeros((0, 1)), np.ones(0))
    measured = usable.select(Summarizer.metrics("count", "variance").summary(array_to_vector("features")).alias("s")).select("s.*").first()
    n, variance = measured["count"], measured["variance"].toArray()
    scale = np.sqrt(variance * (n - 1) / n)
    scale[scale == 0] = 1
    blocks = max(1, -(-n // block_rows))
    digest = F.sha1(F.concat_ws(":", F.lit(str(seed)), "id").cast("binary"))
    usable = usable.withColumns({"digest": digest, "block": F.pmod(F.conv(F.substr(digest, F.lit(1), F.lit(12)), 16, 10).cast("long"), F.lit(blocks))})
    usable = cut(usable.repartition("block").sortWithinPartitions("block", "digest", "id"))
    weights = np.zeros((len(classes), len(scale) + 1))
    number = {c: i for i, c in enumerate(classes)}
    for epoch in range(epochs):
        sent = usable.sparkSession.sparkContext.broadcast(weights)

        def run(batches, epoch=epoch, sent=sent):
            total, count = np.zeros_like(sent.value), 0
            now, done, block = None, 0, None

            def close():
                nonlocal total, count
                if now is not None:
                    total += now * done
                    count += done

            for part in batches:
                starts = np.flatnonzero(np.append(True, part["block"].to_numpy()[1:] != part["block"].to_numpy()[:-1])) if len(part) else []
                for a, b in zip(starts, [*starts[1:], len(part)], strict=True):
                    own = part.iloc[a:b]
                    if own["block"].iloc[0] != block:
                        close()
                        now, done, block = sent.value, 0, own["block"].iloc[0]
                    x, y = np.stack(own["features"].to_numpy()).astype(float) / scale, own["label"].map(number).to_numpy()
                    now = stochastic_steps(now, x, y, epoch * block_rows + done, ridge, rate, power)
                    done += len(own)
            close()
            yield pd.DataFrame({"class": range(len(total)), "rows": count, "sums": list(total)} if count else {"class": [], "rows": [], "sums": pd.Series([], dtype=object)})

        sums = usable.select("block", "label", "features").mapInPandas(run, "class int, rows long, sums array<double>")
        added = sums.groupBy("class").agg(Summarizer.sum(array_to_vector("sums")).alias("sums")).collect()  # a row a class
        weights = np.zeros_like(weights)
        for r in added:
            weights[r["class"]] = r["sums"].toArray() / n
        sent.unpersist()
    return Linear(classes, weights, scale)


def predicted_linear(model: Linear, rows: DataFrame) -> DataFrame:
    """rows with ``predicted``, the class of the largest score (of equal ones the first); null without features or classes."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def best(features: pd.Series) -> pd.Series:
        some = features.notna()
        out = pd.Series([None] * len(features), dtype=object)
        if sent.value.classes and some.any():
            out[some.to_numpy()] = [sent.value.classes[i] for i in sent.value.scores(np.stack(features[some].to_numpy()).astype(float)).argmax(axis=1)]
        return out

    return rows.withColumn("predicted", best(F.col("features")))
