"""Cross-validation and successive halving. Candidates are fitted from driver threads; the data stays on executors."""

from __future__ import annotations

import hashlib
import json
import math
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.evaluate import macro_f1
from tidemark.operators.sampling import hash_draw
from tidemark.operators.skew import group_rank
from tidemark.session import checkpointed

ROWS_PER_TASK = 50_000  # of a sample that is fitted on

# A candidate's maker: (train rows, parameters) -> function from rows to rows with a `predicted` column.
Maker = Callable[[DataFrame, Mapping], Callable[[DataFrame], DataFrame]]

# Names of the usual boosting parameters and what Spark's boosted trees call them.
SPARK_NAMES = {
    "n_estimators": "maxIter",
    "max_depth": "maxDepth",
    "learning_rate": "stepSize",
    "subsample": "subsamplingRate",
    "colsample_bytree": "featureSubsetStrategy",
    "min_child_samples": "minInstancesPerNode",
}


def draw(spec: Mapping, rng: random.Random) -> float | int:
    """One value from {"type": "randint" | "uniform" | "loguniform", "low": .., "high": ..}; `high` is exclusive
    for integers."""
    low, high = spec["low"], spec["high"]
    match spec["type"]:
        case "randint":
            return rng.randrange(low, high)
        case "uniform":
            return rng.uniform(low, high)
        case "loguniform":
            return math.exp(rng.uniform(math.log(low), math.log(high)))
        case other:
            raise ValueError(f"unknown distribution {other!r}")


def draw_all(space: Mapping[str, Mapping], n: int, seed: int = 42) -> list[dict]:
    rng = random.Random(seed)
    return [{name: draw(spec, rng) for name, spec in space.items()} for _ in range(n)]


def spark_params(params: Mapping) -> tuple[dict, list[str]]:
    """Parameters under Spark's names, and the ones Spark's trees have no counterpart for."""
    known = {SPARK_NAMES[k]: v for k, v in params.items() if k in SPARK_NAMES}
    if "featureSubsetStrategy" in known:
        known["featureSubsetStrategy"] = str(known["featureSubsetStrategy"])
    return known, [k for k in params if k not in SPARK_NAMES]


def fold_score(df: DataFrame, make: Maker, params: Mapping, fold: str, actual: str, i: int) -> float:
    """Macro F1 on fold `i` of a model fitted on the others."""
    model = make(df.where(F.col(fold) != i), params)
    return macro_f1(model(df.where(F.col(fold) == i)), actual, "predicted")


def cross_validate(
    df: DataFrame, make: Maker, params: Mapping, fold: str, actual: str, folds: int, threads: int = 4
) -> list[float]:
    """Macro F1 on each fold of a model fitted on the others; the folds are fitted side by side."""
    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(lambda i: fold_score(df, make, params, fold, actual, i), range(folds)))


@dataclass(frozen=True)
class Trial:
    round: int
    candidate: int
    fraction: float
    score: float
    params: dict


def rounds(n: int, factor: int) -> list[int]:
    """Candidates per round: n, then the better ceil(n / factor) of them, until fewer than `factor` remain."""
    sizes = [n]
    while sizes[-1] >= factor:
        sizes.append(math.ceil(sizes[-1] / factor))
    return sizes


def class_sample(df: DataFrame, key: str, label: str, fold: str, fraction: float, seed: int = 42) -> DataFrame:
    """About `fraction` of the rows of each class in each fold, at least one; smaller fractions are subsets of larger.

    A class with rows in every fold keeps rows in every fold, however rare it is.
    """
    if fraction >= 1:
        return df
    drawn = df.withColumn("_draw", hash_draw(key, seed=seed))
    ranked = group_rank(drawn, [label, fold], ["_draw", key], "_nth")
    sizes = df.groupBy(label, fold).agg(F.count("*").alias("_size"))  # one row per class and fold
    kept = ranked.join(F.broadcast(sizes), [label, fold])
    return kept.where(F.col("_nth") < F.greatest(F.lit(1), F.ceil(F.col("_size") * fraction))).select(*df.columns)


LOG_SCHEMA = "search string, round int, candidate int, fold int, score double"


class TrialLog:
    """Finished folds of a search, under a folder: a search that is started again reads them and fits only the rest.

    A search is known by a digest of its candidates, its seed, factor and folds; others may share the folder. One file is
    written for each fold, after its score is known.
    """

    def __init__(self, spark: SparkSession, root: str | None, name: str) -> None:
        self.spark, self.root, self.name = spark, root, name
        self.done: dict[tuple[int, int, int], float] = {}
        if root is not None:
            try:
                rows = spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{root}/{name}").collect()  # one row per fit of the search
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
                rows = []
            self.done = {(r["round"], r["candidate"], r["fold"]): r["score"] for r in rows}

    def add(self, number: int, candidate: int, fold: int, score: float) -> None:
        self.done[number, candidate, fold] = score
        if self.root is not None:
            row = self.spark.createDataFrame([(self.name, number, candidate, fold, score)], LOG_SCHEMA)
            # Folds are written side by side, so each has a folder of its own.
            row.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{self.name}/{number}-{candidate}-{fold}")


def halving_search(
    df: DataFrame,
    make: Maker,
    space: Mapping[str, Mapping],
    key: str,
    actual: str,
    fold: str = "fold",
    folds: int = 5,
    n: int = 50,
    factor: int = 3,
    seed: int = 42,
    threads: int = 4,
    candidates: Sequence[Mapping] | None = None,
    log: str | None = None,
) -> tuple[dict, list[Trial]]:
    """Best parameters and all trials. Each round keeps the better third and gives it three times the rows.

    All folds of all candidates of a round share one cached sample and one queue, from which `threads` driver threads
    fit side by side, so a slow candidate holds up no other. With `log`, a folder, finished folds are written down and a
    search that is called again after a crash goes on where it ended.
    """
    known = [dict(c) for c in (candidates or draw_all(space, n, seed))]
    alive = list(enumerate(known))
    sizes = rounds(len(alive), factor)
    name = hashlib.sha256(json.dumps([known, seed, factor, folds], sort_keys=True).encode()).hexdigest()[:16]
    book = TrialLog(df.sparkSession, log, name)
    trials: list[Trial] = []
    for number, size in enumerate(sizes):
        alive = alive[:size]
        fraction = factor ** -(len(sizes) - 1 - number)
        queue = [(which, params, i) for which, params in alive for i in range(folds) if (number, which, i) not in book.done]
        if queue:
            # A sample is passed over some hundred times: small ones must not be spread over many tasks.
            drawn = checkpointed(class_sample(df, key, actual, fold, fraction, seed))
            rows = drawn.coalesce(-(-drawn.count() // ROWS_PER_TASK) or 1).persist()

            def score(entry, rows=rows, number=number):
                which, params, i = entry
                book.add(number, which, i, fold_score(rows, make, params, fold, actual, i))

            try:
                with ThreadPoolExecutor(threads) as pool:
                    list(pool.map(score, queue))
            finally:
                rows.unpersist()
        marks = {which: [book.done[number, which, i] for i in range(folds)] for which, _ in alive}
        done = [Trial(number, which, fraction, sum(marks[which]) / folds, dict(params)) for which, params in alive]
        trials += done
        ranked = sorted(done, key=lambda t: (-t.score, t.candidate))
        alive = [(t.candidate, t.params) for t in ranked]
    return alive[0][1], trials
