"""Classifier metrics on fixed predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.base import PREDICTIONS_SQL, predictions, query, rounded, table
from tidemark.functions import scalars
from tidemark.operators import evaluate as ev
from tidemark.streaming import live

PAIRS = f"""with pr as ({PREDICTIONS_SQL}), cm as (select actual, predicted, count(*) as n from pr
  where actual is not null and predicted <> 'ERROR' group by actual, predicted)"""
COUNTS = f"""{PAIRS}, names as (select actual as class from cm union select predicted from cm),
  ct as (select class, cast(coalesce(sum(n) filter (actual = class and predicted = class), 0) as bigint) as tp,
    cast(coalesce(sum(n) filter (actual <> class and predicted = class), 0) as bigint) as fp,
    cast(coalesce(sum(n) filter (actual = class and predicted <> class), 0) as bigint) as fn
    from names left join cm on actual = class or predicted = class group by class)"""
SCORES = f"""{COUNTS}, s0 as (select *, case when tp + fp > 0 then tp / (tp + fp) else 0.0 end as p,
    case when tp + fn > 0 then tp / (tp + fn) else 0.0 end as r from ct),
  s as (select *, case when p + r > 0 then 2 * p * r / (p + r) else 0.0 end as f from s0)"""


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    return ev.confusion(predictions(spark, sf), "actual", "predicted")


@query("G7", f"{PAIRS} select actual, predicted, n from cm")
def confusion_counts(spark: SparkSession, sf: str) -> DataFrame:
    return pairs(spark, sf)


@query("G7", f"""{COUNTS} select a.class as actual, b.class as predicted, coalesce(n, 0) as n,
  round(coalesce(n, 0) / nullif(sum(coalesce(n, 0)) over (partition by a.class), 0), 6) as share
  from names a cross join names b left join cm on cm.actual = a.class and cm.predicted = b.class""")
def full_confusion(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.full_confusion(pairs(spark, sf)))


@query("G8", f"{COUNTS} select * from ct")
def one_vs_rest_counts(spark: SparkSession, sf: str) -> DataFrame:
    return ev.ovr_counts(pairs(spark, sf))


@query("G9 S14 S18", f"""{SCORES} select class, tp, fp, fn, round(p, 6) as precision, round(r, 6) as recall,
  round(f, 6) as f1, tp + fn as support, case when f < 0.3 then 'low' when f < 0.6 then 'middle' else 'high' end as band
  from s""")
def class_scores(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.class_prf(ev.ovr_counts(pairs(spark, sf))))


@query("G10", f"""{SCORES} select round(avg(p), 6) as macro_precision, round(avg(r), 6) as macro_recall,
  round(avg(f), 6) as macro_f1 from s where tp + fp + fn > 0""")
def macro_scores(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.macro_prf(ev.ovr_counts(pairs(spark, sf))))


@query("G11 M13", f"""{SCORES} select round(avg(f) filter (tp + fp + fn > 0), 6) as macro_f1,
  round(avg(r) filter (tp + fn > 0), 6) as balanced_accuracy from s""")
def evaluated_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.evaluate(predictions(spark, sf), "actual", "predicted"))


@query("G12", f"""{PAIRS}, t as (select *, round(n * 100.0 / sum(n) over (partition by actual), 6) as percent_of_actual
  from cm) select * from t where actual <> predicted order by n desc, actual, predicted limit 20""")
def frequent_mistakes(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.top_confusions(pairs(spark, sf)))


@query("G13", f"""{PAIRS}, b as (select
    cast(coalesce(sum(n) filter (actual <> 'view' and predicted <> 'view'), 0) as bigint) as tp,
    cast(coalesce(sum(n) filter (actual = 'view' and predicted <> 'view'), 0) as bigint) as fp,
    cast(coalesce(sum(n) filter (actual <> 'view' and predicted = 'view'), 0) as bigint) as fn from cm)
  select tp, fp, fn, round(tp / (tp + fp), 6) as precision, round(tp / (tp + fn), 6) as recall,
  round(2 * tp / (2 * tp + fp + fn), 6) as f1 from b""")
def first_stage_f1(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.binary_f1(pairs(spark, sf), "view"))


# One "model" per part brand, scored by its prices.
RESULTS = """with r as (select p_brand as model, substr(p_brand, 7, 1) as tier, 'flat' as approach,
    avg(p_size) / 50 as macro_f1, min(p_size) / 50 as balanced_accuracy from part group by p_brand)"""


def results(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").groupBy(F.col("p_brand").alias("model")).agg(
        F.substring(F.first("p_brand"), 7, 1).alias("tier"), F.lit("flat").alias("approach"),
        (F.avg("p_size") / 50).alias("macro_f1"), (F.min("p_size") / 50).alias("balanced_accuracy"),
    )


@query("G14 M12", f"""{RESULTS} select model, tier, approach, round(macro_f1, 6) as macro_f1,
  round(balanced_accuracy, 6) as balanced_accuracy,
  cast(row_number() over (order by macro_f1 desc, model) as int) as rank,
  round(macro_f1 - (select macro_f1 from r where model = 'Brand#1'), 6) as gain from r""")
def model_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.leaderboard(results(spark, sf), "Brand#1"))


@query("G16", """select p_brand as model, round(avg(p_retailprice), 6) as cv_mean,
  round(stddev_pop(p_retailprice), 6) as cv_std from part group by p_brand""")
def fold_score_summary(spark: SparkSession, sf: str) -> DataFrame:
    scores = table(spark, sf, "part").select(F.col("p_brand").alias("model"), F.col("p_retailprice").alias("score"))
    return rounded(ev.cv_summary(scores))


@query("G15", f"""{SCORES} select (select count(*) from pr) as rows, (select count(*) from pr where actual is not null) as labelled,
  (select count(*) from pr where predicted = 'ERROR') as errors, (select count(*) from names) as classes,
  round(avg(f), 6) as macro_f1 from s""")
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.run_summary(predictions(spark, sf), "actual", "predicted"))


@query("W11", f"""with pr as ({PREDICTIONS_SQL}), nth as (select *, row_number() over (order by ts, row_id) - 1 as i from pr),
  k as (select cast(floor(i / 200) as bigint) as step, actual, predicted from nth
        where actual is not null and predicted <> 'ERROR'),
  st as (select cast(floor(i / 200) as bigint) as step from nth group by 1 having count(*) = 200),
  names as (select actual as class from k union select predicted from k),
  d as (select step, class, count(*) filter (actual = class and predicted = class) as tp,
    count(*) filter (actual <> class and predicted = class) as fp,
    count(*) filter (actual = class and predicted <> class) as fn
    from k join names on actual = class or predicted = class group by step, class),
  g as (select st.step, class from st, names),
  u as (select g.step, g.class, sum(coalesce(tp, 0)) over w as tp, sum(coalesce(fp, 0)) over w as fp,
    sum(coalesce(fn, 0)) over w as fn from g left join d on d.step = g.step and d.class = g.class
    window w as (partition by g.class order by g.step)),
  s0 as (select *, case when tp + fp > 0 then tp / (tp + fp) else 0.0 end as p,
    case when tp + fn > 0 then tp / (tp + fn) else 0.0 end as r from u where tp + fp + fn > 0),
  s as (select *, case when p + r > 0 then 2 * p * r / (p + r) else 0.0 end as f from s0)
  select (step + 1) * 200 as rows_done, round(avg(p), 6) as macro_precision, round(avg(r), 6) as macro_recall,
  round(avg(f), 6) as macro_f1 from s group by step""")
def metric_trajectory(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ev.trajectory(predictions(spark, sf), "actual", "predicted", ["ts", "row_id"], every=200))


@query("O2", "select event_id from events order by ts, event_id limit 3000")
def scored_row_cap(spark: SparkSession, sf: str) -> DataFrame:
    return live.first_rows(table(spark, sf, "events"), "ts", "event_id", 3000).select("event_id")


@query("O3", "select event_id, event_type from events order by ts desc, event_id desc limit 14")
def latest_scored_rows(spark: SparkSession, sf: str) -> DataFrame:
    return live.latest_rows(table(spark, sf, "events"), "ts", "event_id").select("event_id", "event_type")


@query("S15", """select vec_id, cast(list_position(embedding, list_max(embedding)) - 1 as int) as label,
  round(cast(list_max(embedding) as double), 6) as confidence from embeddings""")
def best_component(spark: SparkSession, sf: str) -> DataFrame:
    """Label and confidence by the largest entry of a vector."""
    rows = table(spark, sf, "embeddings")
    names = F.transform("embedding", lambda x, i: i)
    label, top = scalars.best_of(F.col("embedding"), names)
    return rounded(rows.select("vec_id", label.alias("label"), top.cast("double").alias("confidence")))


@query("S16", """with n as (select distinct p_type || ' of the longer names ' || p_brand as label from part),
  k as (select label, row_number() over (partition by substr(label, 1, 24) order by label) - 2 as nth from n)
  select label, 'prob_' || substr(label, 1, 24) || case when nth < 0 then '' else '_' || lpad(cast(nth as varchar), 4, '0') end
  as name from k""")
def probability_columns(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.operators.labels import label_index, label_list

    rows = table(spark, sf, "part").select(F.concat("p_type", F.lit(" of the longer names "), "p_brand").alias("label"))
    names = label_list(label_index(rows, "label"), "label")
    return spark.createDataFrame(list(zip(names, scalars.probability_names(names))), "label string, name string")
