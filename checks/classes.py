"""Classes, labels, rates, folds and weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.base import query, rounded, statements, table
from checks.sqltext import ST
from tidemark.functions import scalars
from tidemark.operators import labels, models, quality, rates, split

TARGET = f"{ST}, t as (select *, replace(category, 'STATEMENT_CATEGORY_', '') as target, row_id % 5 = 0 as is_test from st)"


def targets(spark: SparkSession, sf: str) -> DataFrame:
    rows = statements(spark, sf).select("row_id", "category", "platform_name", "automated_detection")
    rows = rows.withColumn("target", scalars.strip_prefix("category", "STATEMENT_CATEGORY_"))
    return rows.withColumn("is_test", F.col("row_id") % 5 == 0)


@query("G1", f"""{TARGET} select target, count(*) as rows,
  round(count(*) * 100.0 / (select count(*) from t), 6) as percent from t group by target""")
def class_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(quality.class_distribution(targets(spark, sf), "target"))


@query("G2 G6", f"""{TARGET}, c as (select count(*) as n from t where not is_test group by target)
  select count(*) as classes, min(n) as smallest, max(n) as largest, round(max(n) / min(n), 6) as imbalance from c""")
def train_class_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(quality.class_summary(targets(spark, sf).where("not is_test"), "target"))


@query("G5", f"{ST} select count(distinct platform_name) as platforms from st")
def distinct_platforms(spark: SparkSession, sf: str) -> DataFrame:
    return statements(spark, sf).agg(F.countDistinct("platform_name").alias("platforms"))


@query("C8", f"""{TARGET} select row_id, target from t
  where target in (select target from t group by target having count(*) > 20)""")
def without_rare_classes(spark: SparkSession, sf: str) -> DataFrame:
    return quality.drop_rare(targets(spark, sf), "target").select("row_id", "target")


@query("J5 C8", f"""{TARGET} select row_id, target from t
  where target not in (select target from t group by target having count(*) <= 20)""")
def rare_classes_removed(spark: SparkSession, sf: str) -> DataFrame:
    rows = targets(spark, sf)
    return quality.drop_classes(rows, quality.rare_classes(rows, "target"), "target").select("row_id", "target")


# Parts by brand and size: many classes, some of them tiny.
PART = "p as (select p_partkey, concat(p_brand, '/', cast(p_size as string)) as cls, p_partkey % 3 = 0 as is_test from part)"


def parts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr(
        "p_partkey", "concat(p_brand, '/', cast(p_size as string)) as cls", "p_partkey % 3 = 0 as is_test"
    )


@query("C9", f"""with {PART} select p_partkey, cls, is_test from p
  where cls in (select cls from p group by cls having count(*) filter (not is_test) >= 2)""")
def without_sparse_classes(spark: SparkSession, sf: str) -> DataFrame:
    return quality.drop_sparse(parts(spark, sf), "cls", "is_test")


@query("C10", f"""with {PART} select cls, count(*) filter (not is_test) as train_rows from p group by cls
  having count(*) filter (not is_test) = 1""")
def singleton_classes(spark: SparkSession, sf: str) -> DataFrame:
    return quality.singleton_classes(parts(spark, sf), "cls", "is_test")


@query("O6", f"""with {PART} select distinct cls from p where is_test
  and cls not in (select cls from p where not is_test)""")
def classes_only_in_test(spark: SparkSession, sf: str) -> DataFrame:
    return quality.only_test_classes(parts(spark, sf), "cls", "is_test")


@query("E1 O1", f"""with {PART} select cls, cast(row_number() over (order by cls) - 1 as int) as label_id
  from (select distinct cls from p)""")
def label_ids(spark: SparkSession, sf: str) -> DataFrame:
    return labels.label_index(parts(spark, sf), "cls")


@query("E1 J4", f"""{TARGET}, i as (select target, cast(row_number() over (order by target) - 1 as int) as label_id
    from (select distinct target from t))
  select row_id, t.target, i.label_id, t.target as decoded from t join i using (target)""")
def encoded_labels(spark: SparkSession, sf: str) -> DataFrame:
    rows = targets(spark, sf).select("row_id", "target")
    index = labels.label_index(rows, "target")
    coded = labels.encode_label(rows, index, "target")
    return labels.decode_label(coded, index.withColumnRenamed("target", "decoded"), "label_id").select(
        "row_id", "target", "label_id", "decoded"
    )


@query("E2 C9", f"""with {PART}, k as (select * from p
    where cls in (select cls from p group by cls having count(*) filter (not is_test) >= 2))
  select p_partkey, cls, cast(dense_rank() over (order by cls) - 1 as int) as label_id from k""")
def remapped_labels(spark: SparkSession, sf: str) -> DataFrame:
    kept = quality.drop_sparse(parts(spark, sf), "cls", "is_test")
    return labels.encode_label(kept, labels.label_index(kept, "cls"), "cls").select("p_partkey", "cls", "label_id")


@query("C17", f"{TARGET} select row_id, target from t where target <> 'OTHER_VIOLATION_TC'")
def second_stage_rows(spark: SparkSession, sf: str) -> DataFrame:
    return targets(spark, sf).where(F.col("target") != "OTHER_VIOLATION_TC").select("row_id", "target")


@query("G3", f"""{TARGET} select platform_name, round(avg(case when lower(coalesce(automated_detection, '')) = 'yes'
  then 1.0 else 0.0 end), 6) as rate from t where not is_test and platform_name is not null group by platform_name""")
def platform_rates(spark: SparkSession, sf: str) -> DataFrame:
    train = targets(spark, sf).where("not is_test")
    return rounded(rates.group_rate(train, "platform_name", scalars.yes_flag("automated_detection")))


RATED = f"""{TARGET}, r as (select platform_name, avg(case when lower(coalesce(automated_detection, '')) = 'yes'
    then 1.0 else 0.0 end) as rate from t where not is_test and platform_name <> 'p3' group by platform_name)
  select row_id, round(coalesce(r.rate, 0.0), 6) as rate from t left join r using (platform_name)"""


@query("J3", RATED)
def platform_rate_lookup(spark: SparkSession, sf: str) -> DataFrame:
    rows = targets(spark, sf)
    train = rows.where("not is_test and platform_name <> 'p3'")
    known = rates.group_rate(train, "platform_name", scalars.yes_flag("automated_detection"))
    return rounded(rates.apply_rate(rows, known, "platform_name").select("row_id", "rate"))


@query("J3", RATED)
def platform_rate_salted(spark: SparkSession, sf: str) -> DataFrame:
    """The same lookup as if the rate table were too large to broadcast: hot platforms are salted."""
    from tidemark.operators.skew import lookup

    rows = targets(spark, sf)
    train = rows.where("not is_test and platform_name <> 'p3'")
    known = rates.group_rate(train, "platform_name", scalars.yes_flag("automated_detection"))
    joined = lookup(rows, known, "platform_name", spread_by=["row_id"], limit=0, salts=8)
    return rounded(joined.select("row_id", F.coalesce("rate", F.lit(0.0)).alias("rate")))


@query("M1", f"""{TARGET}, m as (select target from t where not is_test group by target order by count(*) desc, target limit 1)
  select row_id, target as actual, (select target from m) as predicted from t where is_test""")
def majority_baseline(spark: SparkSession, sf: str) -> DataFrame:
    rows = targets(spark, sf)
    top = models.most_frequent(rows.where("not is_test"), "target")
    return rows.where("is_test").select("row_id", F.col("target").alias("actual"), F.lit(top).alias("predicted"))


@query("M3", f"""{TARGET}, c as (select target, count(*) as n from t group by target)
  select target, round((select sum(n) from c) / ((select count(*) from c) * n), 6) as weight from c""")
def balanced_weights(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(models.class_weights(targets(spark, sf), "target"))


def folds_sql(source: str, label: str, key: str, k: int) -> str:
    return f"""
  c as (select {label}, count(*) as n, min({key}) as first from {source} group by {label}),
  o as (select *, coalesce(sum(n) over (order by first rows between unbounded preceding and 1 preceding), 0) as start from c),
  dealt as (select o.{label}, o.start + i as place, (o.start + i) % {k} as fold,
            from o, unnest(range(cast(n as bigint))) u(i)),
  sizes as (select {label}, fold, count(*) as n from dealt group by 1, 2),
  ends as (select {label}, fold, sum(n) over (partition by {label} order by fold) as upto from sizes),
  ranked as (select *, row_number() over (partition by {label} order by {key}) - 1 as nth from {source})
  select ranked.{key}, ranked.{label}, cast(min(ends.fold) as int) as fold
  from ranked join ends on ends.{label} = ranked.{label} and ranked.nth < ends.upto group by 1, 2"""


@query("M8", f"{TARGET}, {folds_sql('t', 'target', 'row_id', 5)}")
def five_folds(spark: SparkSession, sf: str) -> DataFrame:
    rows = targets(spark, sf).select("row_id", "target")
    return split.stratified_folds(rows, "target", ["row_id"], 5)


@query("M8", f"with {PART}, {folds_sql('p', 'cls', 'p_partkey', 3)}")
def three_folds_small_classes(spark: SparkSession, sf: str) -> DataFrame:
    return split.stratified_folds(parts(spark, sf).select("p_partkey", "cls"), "cls", ["p_partkey"], 3)


@query("M8", f"{TARGET}, {folds_sql('t', 'target', 'row_id', 5)}")
def five_folds_hot_class(spark: SparkSession, sf: str) -> DataFrame:
    """The same folds with classes cut into small cells, as a class with most of the rows would be."""
    rows = targets(spark, sf).select("row_id", "target")
    return split.stratified_folds(rows, "target", ["row_id"], 5, max_rows=200)
