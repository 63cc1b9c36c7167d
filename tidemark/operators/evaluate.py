"""Classifier metrics. All start from `confusion`, one pre-aggregated pass over the predictions."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions.scalars import f1_band, f1_score, safe_div
from tidemark.operators.skew import group_rank, is_small, running_sums, with_cells
from tidemark.session import checkpointed

STEP_ROWS = 500_000  # rows of a trajectory that one task puts in order
ERROR_LABEL = "ERROR"  # fixed value: the prediction of a row that could not be scored


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """(actual, predicted, n) over the pairs that occur; unlabelled and failed rows are left out."""
    known = F.col(actual).isNotNull() & F.col(predicted).isNotNull() & (F.col(predicted) != ERROR_LABEL)
    return df.where(known).groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n")
    )


def class_table(pairs: DataFrame) -> DataFrame:
    """(class): labels seen as actual or predicted."""
    return pairs.select(F.explode(F.array("actual", "predicted")).alias("class")).distinct()


def full_confusion(pairs: DataFrame, classes: Sequence[str] | None = None) -> DataFrame:
    """Every cell of the matrix with its count and its share of the actual class; zero cells included.

    The matrix has a cell for any two classes by its nature: its size is the square of their number, which no list of
    classes passes the driver for.
    """
    if classes is None:
        pairs = checkpointed(pairs)
        names = checkpointed(class_table(pairs))
    else:
        names = pairs.sparkSession.createDataFrame([(c,) for c in classes], "class string")
    row = names.agg(F.sort_array(F.collect_set("class"))).scalar()
    cells = names.select(F.col("class").alias("actual"), F.explode(row).alias("predicted"))
    filled = cells.join(F.broadcast(pairs) if is_small(pairs) else pairs, ["actual", "predicted"], "left")
    n = F.coalesce("n", F.lit(0))
    total = F.sum(n).over(Window.partitionBy("actual"))
    return filled.select("actual", "predicted", n.alias("n"), safe_div(n, total).alias("share"))


def _sides() -> Column:
    """What a pair says of its actual and of its predicted class."""
    hit = F.col("actual") == F.col("predicted")
    zero, n = F.lit(0).cast("long"), F.col("n")
    return F.array(
        F.struct(
            F.col("actual").alias("class"),
            F.when(hit, n).otherwise(zero).alias("tp"),
            zero.alias("fp"),
            F.when(hit, zero).otherwise(n).alias("fn"),
        ),
        F.struct(
            F.col("predicted").alias("class"),
            zero.alias("tp"),
            F.when(hit, zero).otherwise(n).alias("fp"),
            zero.alias("fn"),
        ),
    )


def ovr_counts(pairs: DataFrame) -> DataFrame:
    """(class, tp, fp, fn), one against the rest."""
    return pairs.select(F.inline(_sides())).groupBy("class").agg(
        F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn")
    )


def _prf(tp: str = "tp", fp: str = "fp", fn: str = "fn") -> dict[str, Column]:
    precision = safe_div(F.col(tp), F.col(tp) + F.col(fp))
    recall = safe_div(F.col(tp), F.col(tp) + F.col(fn))
    return {"precision": precision, "recall": recall, "f1": f1_score(precision, recall)}


def class_prf(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1, support and F1 band by class."""
    out = counts.withColumns(_prf()).withColumn("support", F.col("tp") + F.col("fn"))
    return out.withColumn("band", f1_band(F.col("f1")))


def macro_prf(counts: DataFrame) -> DataFrame:
    """Means over the classes that occur; 0 where none does."""
    seen = class_prf(counts).where(F.col("tp") + F.col("fp") + F.col("fn") > 0)
    return seen.agg(
        *[F.coalesce(F.avg(c), F.lit(0.0)).alias(f"macro_{c}") for c in ("precision", "recall", "f1")]
    )


def balanced_accuracy(counts: DataFrame) -> DataFrame:
    """Mean recall over the classes that truly occur."""
    recalls = class_prf(counts).where(F.col("support") > 0)
    return recalls.agg(F.coalesce(F.avg("recall"), F.lit(0.0)).alias("balanced_accuracy"))


def binary_f1(pairs: DataFrame, other: str) -> DataFrame:
    """F1 of telling any class from `other`, the positive side being not `other`."""
    a, p, n = F.col("actual") != other, F.col("predicted") != other, F.col("n")
    sums = pairs.agg(
        F.coalesce(F.sum(F.when(a & p, n)), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(~a & p, n)), F.lit(0)).alias("fp"),
        F.coalesce(F.sum(F.when(a & ~p, n)), F.lit(0)).alias("fn"),
    )
    return sums.withColumns(_prf())


def top_confusions(pairs: DataFrame, n: int = 20) -> DataFrame:
    """The `n` most frequent mistakes and their percentage of the true class."""
    share = F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy("actual"))
    wrong = pairs.withColumn("percent_of_actual", share).where("actual <> predicted")
    return wrong.orderBy(F.desc("n"), "actual", "predicted").limit(n)


def trajectory(
    df: DataFrame,
    actual: str,
    predicted: str,
    order: Sequence[str],
    every: int = 20,
    max_rows: int = STEP_ROWS,
    offset: int = 0,
    before: DataFrame | None = None,
) -> DataFrame:
    """Macro metrics after every `every` rows: (rows_done, macro_precision, macro_recall, macro_f1).

    A step changes the counts of the classes it holds; each change moves the sums of precision, recall and F1 over the
    classes, and those sums are added up over the steps. So the work goes with the changes, not with steps x classes.
    To go on where an earlier call ended, give its number of rows as `offset` and its confusion counts as `before`.

    The rows are one sequence, put in order in cells of about `max_rows`. Cells are cut and summed in several passes, so
    the rows and the counts by step and class are kept first.
    """
    df = checkpointed(df.select(*dict.fromkeys([*order, actual, predicted]), F.lit(0).alias("_all")))
    ranked = group_rank(df, ["_all"], order, "_nth", max_rows)
    nth = F.col("_nth") + offset
    ranked = ranked.withColumn("_step", ((nth - nth % every) / every).cast("long"))
    known = F.col(actual).isNotNull() & F.col(predicted).isNotNull() & (F.col(predicted) != ERROR_LABEL)
    pairs = ranked.where(known).groupBy(
        "_step", F.col(actual).alias("actual"), F.col(predicted).alias("predicted")
    ).agg(F.count("*").alias("n"))
    if before is not None:
        pairs = pairs.unionByName(before.select(F.lit(-1).cast("long").alias("_step"), "actual", "predicted", "n"))
    per_step = pairs.select("_step", F.inline(_sides())).groupBy("_step", "class").agg(
        *[F.sum(c).alias(f"_{c}") for c in ("tp", "fp", "fn")]
    )
    cells = with_cells(checkpointed(per_step), ["class"], ["_step"], max_rows)
    sums = running_sums(cells, ["class"], ["_step"], {c: F.col(f"_{c}") for c in ("tp", "fp", "fn")})
    sums = sums.withColumns({f"_{c}": F.col(c) + F.col(f"_{c}") for c in ("tp", "fp", "fn")})
    old, new = _prf(), _prf("_tp", "_fp", "_fn")
    seen_before = (F.col("tp") + F.col("fp") + F.col("fn") > 0).cast("int")
    seen_now = (F.col("_tp") + F.col("_fp") + F.col("_fn") > 0).cast("int")
    change = {c: new[c] - old[c] for c in _MACRO} | {"seen": seen_now - seen_before}
    moved = sums.groupBy("_step").agg(*[F.sum(x).alias(f"_d_{c}") for c, x in change.items()])
    # Every full step has a row, whether it changes anything or not.
    rows = F.count(F.lit(1)) + offset
    ends = df.agg(rows.alias("_rows")).where(F.floor(F.col("_rows") / every) > offset // every).select(
        F.explode(F.sequence(F.lit(offset // every).cast("long"), F.floor(F.col("_rows") / every) - 1)).alias("_step"),
        F.lit(True).alias("_full"),
    )
    steps = moved.join(ends, "_step", "full").na.fill(0).withColumn("_all", F.lit(0))
    cells = with_cells(checkpointed(steps), ["_all"], ["_step"], max_rows)
    upto = running_sums(cells, ["_all"], ["_step"], {f"_s_{c}": F.col(f"_d_{c}") for c in (*_MACRO, "seen")})
    seen = F.col("_s_seen") + F.col("_d_seen")
    means = [F.when(seen > 0, (F.col(f"_s_{c}") + F.col(f"_d_{c}")) / seen).otherwise(F.lit(0.0)).alias(f"macro_{c}") for c in _MACRO]
    return upto.where("_full").select(((F.col("_step") + 1) * every).alias("rows_done"), *means)


_MACRO = ("precision", "recall", "f1")


# --- results of several models ---------------------------------------------------------

RESULTS_SCHEMA = (
    "model string, tier string, approach string, macro_f1 double, balanced_accuracy double, "
    "cv_f1_mean double, cv_f1_std double"
)


def evaluate(predictions: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: macro F1 and balanced accuracy, over all rows with a known label."""
    counts = ovr_counts(confusion(predictions, actual, predicted))
    seen = class_prf(counts).where(F.col("tp") + F.col("fp") + F.col("fn") > 0)
    return seen.agg(
        F.coalesce(F.avg("f1"), F.lit(0.0)).alias("macro_f1"),
        F.coalesce(F.avg(F.when(F.col("support") > 0, F.col("recall"))), F.lit(0.0)).alias("balanced_accuracy"),
    )


def run_summary(predictions: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row about a scoring run: rows, labelled rows, rows that could not be scored, classes seen, and macro F1."""
    counts = ovr_counts(confusion(predictions, actual, predicted))
    return predictions.agg(
        F.count("*").alias("rows"),
        F.count(actual).alias("labelled"),
        F.count_if(F.col(predicted) == ERROR_LABEL).alias("errors"),
    ).withColumns(
        {
            "classes": counts.agg(F.count("*")).scalar(),
            "macro_f1": macro_prf(counts).select("macro_f1").scalar(),
        }
    )


def macro_f1(predictions: DataFrame, actual: str, predicted: str) -> float:
    """Macro F1 as a number, in one job: for searches that need it hundreds of times.

    The confusion counts come to the driver, which holds the classes of a fitted model anyway.
    """
    hits: Counter = Counter()
    sides: Counter = Counter()  # 2 tp + fp + fn
    for r in confusion(predictions, actual, predicted).collect():
        sides[r["actual"]] += r["n"]
        sides[r["predicted"]] += r["n"]
        if r["actual"] == r["predicted"]:
            hits[r["actual"]] += r["n"]
    return sum(2 * hits[c] / n for c, n in sides.items()) / len(sides) if sides else 0.0


def record(
    spark: SparkSession, predictions: DataFrame, actual: str, predicted: str, model: str, tier: str, approach: str,
    cv_scores: Sequence[float] = (),
) -> DataFrame:
    """One row of the results table."""
    scores = evaluate(predictions, actual, predicted).first()
    mean = sum(cv_scores) / len(cv_scores) if cv_scores else None
    std = (sum((s - mean) ** 2 for s in cv_scores) / len(cv_scores)) ** 0.5 if cv_scores else None
    row = (model, tier, approach, scores["macro_f1"], scores["balanced_accuracy"], mean, std)
    return spark.createDataFrame([row], RESULTS_SCHEMA)


def leaderboard(results: DataFrame, baseline: str | None = None) -> DataFrame:
    """Results by macro F1, best first, with rank and lead over the baseline model."""
    rank = F.row_number().over(Window.orderBy(F.desc("macro_f1"), "model"))  # one row per model
    floor = F.max(F.when(F.col("model") == baseline, F.col("macro_f1"))).over(Window.partitionBy())
    return results.withColumn("rank", rank).withColumn("gain", F.col("macro_f1") - floor).orderBy("rank")


def cv_summary(scores: DataFrame, model: str = "model", score: str = "score") -> DataFrame:
    """Mean and population deviation of the fold scores of each model."""
    return scores.groupBy(model).agg(F.avg(score).alias("cv_mean"), F.stddev_pop(score).alias("cv_std"))
