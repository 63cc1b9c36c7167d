"""Row-wise functions, guards and the feature plan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.base import list_count_sql, list_first_sql, query, rounded, statements, table
from checks.sqltext import ACC, APP, CNT, FRAME_ROWS, MON, PRO, ST, VIS, rolling_sql, select_list, structured_sql
from tidemark.functions import parse, scalars
from tidemark.operators import quality
from tidemark.operators.rates import group_rate
from tidemark.plans import features as fe
from tidemark.sources.store import widen_integers

SPEC = fe.Spec()


@query("S1 S2", f"""{ST} select row_id, {list_first_sql('content_type')} as content_type_primary,
  {list_count_sql('content_type')} as content_type_count,
  {list_first_sql('territorial_scope')} as territorial_scope_primary,
  {list_count_sql('territorial_scope')} as territorial_scope_count,
  {list_first_sql('decision_visibility')} as decision_visibility_primary,
  {list_count_sql('decision_visibility')} as visibility_decision_count from st""")
def list_strings(spark: SparkSession, sf: str) -> DataFrame:
    return statements(spark, sf).select(
        "row_id",
        parse.list_first("content_type").alias("content_type_primary"),
        parse.list_count("content_type").alias("content_type_count"),
        parse.list_first("territorial_scope").alias("territorial_scope_primary"),
        parse.list_count("territorial_scope").alias("territorial_scope_count"),
        parse.list_first("decision_visibility").alias("decision_visibility_primary"),
        parse.list_count("decision_visibility").alias("visibility_decision_count"),
    )


@query("S3 S4 S5", f"""{ST} select row_id, {MON} as has_monetary_decision, {PRO} as has_provision_decision,
  {ACC} as has_account_decision, ({VIS}) + ({MON}) + ({PRO}) + ({ACC}) as total_decision_actions,
  case when ({VIS}) + ({MON}) + ({PRO}) + ({ACC}) > 1 then 1 else 0 end as is_multi_action_decision from st""")
def decision_flags(spark: SparkSession, sf: str) -> DataFrame:
    return fe.derive(statements(spark, sf)).select(
        "row_id", "has_monetary_decision", "has_provision_decision", "has_account_decision",
        "total_decision_actions", "is_multi_action_decision",
    )


@query("S6 S7 S8", f"""{ST} select row_id, strftime({APP}, '%Y-%m-%d %H:%M:%S') as applied,
  strftime({CNT}, '%Y-%m-%d %H:%M:%S') as posted, cast(year({APP}) as int) as app_year,
  cast(month({APP}) as int) as app_month, cast(year({CNT}) as int) as content_year,
  cast(floor((epoch_us({APP}) - epoch_us({CNT})) / 86400000000.0) as int) as lag_days from st""")
def dates_and_lag(spark: SparkSession, sf: str) -> DataFrame:
    form = "yyyy-MM-dd HH:mm:ss"
    return fe.derive(statements(spark, sf)).select(
        "row_id",
        F.date_format(parse.lenient_timestamp("application_date"), form).alias("applied"),
        F.date_format(parse.lenient_timestamp("content_date"), form).alias("posted"),
        "app_year", "app_month", "content_year", F.col("content_application_lag_days").alias("lag_days"),
    )


@query("S8 J2", """select l_orderkey, l_linenumber, l_partkey, l_extendedprice,
  cast(floor((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400000000.0) as int) as lag_days
  from lineitem left join orders on o_orderkey = l_orderkey""")
def shipping_lag(spark: SparkSession, sf: str) -> DataFrame:
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    dates = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return lines.join(dates, "l_orderkey", "left").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        scalars.lag_days("l_shipdate", "o_orderdate").alias("lag_days"),
    )


@query("S9 C5", """select doc_id, cast(length(coalesce(text, '')) as int) as text_len,
  case when coalesce(text, '') <> '' then 1 else 0 end as filled from documents""")
def text_lengths(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id",
        scalars.text_length("text").alias("text_len"),
        (quality.empty_text("text") != "").cast("int").alias("filled"),
    )


@query("S10 S11 S12 S17", f"""{ST} select row_id, replace(category, 'STATEMENT_CATEGORY_', '') as target,
  case when lower(coalesce(automated_detection, '')) = 'yes' then 1 else 0 end as auto,
  coalesce({list_first_sql('content_type')}, 'UNKNOWN') as kind,
  case when category_specification is not null
       then replace(category, 'STATEMENT_CATEGORY_', '') = category_specification end as same from st""")
def label_and_flags(spark: SparkSession, sf: str) -> DataFrame:
    target = scalars.strip_prefix("category", SPEC.prefix)
    return statements(spark, sf).select(
        "row_id",
        target.alias("target"),
        scalars.yes_flag("automated_detection").alias("auto"),
        F.coalesce(parse.list_first("content_type"), F.lit("UNKNOWN")).alias("kind"),
        scalars.correct_flag(target, F.col("category_specification")).alias("same"),
    )


@query("S13", "select count(*) as rows, count(*) as keys, 64 as shortest, 64 as longest from lineitem")
def row_keys(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    place = [F.col("_metadata.file_name"), F.col("_metadata.row_index")]
    keyed = lines.select(scalars.row_key(None, [*place, *[F.col(c) for c in lines.columns]]).alias("row_id"), "*")
    return keyed.agg(
        F.count("*").alias("rows"), F.countDistinct("row_id").alias("keys"),
        F.min(F.length("row_id")).alias("shortest"), F.max(F.length("row_id")).alias("longest"),
    )


@query("C1 C2 C3 C4 C16", f"""{ST} select row_id, {select_list({
    k: v for k, v in structured_sql().items()})}, cast(-1 as bigint) as never_seen from st""")
def filled_features(spark: SparkSession, sf: str) -> DataFrame:
    derived = fe.derive(statements(spark, sf)).drop("incompatible_content_illegal")
    derived = derived.withColumn("incompatible_content_illegal", F.expr(
        "case row_id % 7 when 0 then null when 1 then 'Yes' else 'No' end"))
    full = quality.add_missing(derived, SPEC.categorical, (*SPEC.numeric, "never_seen"))
    return widen_integers(full.select(
        "row_id",
        *[quality.impute_text(c).alias(c) for c in SPEC.categorical],
        *[quality.impute_number(c).alias(c) for c in (*SPEC.numeric, "never_seen")],
    ))


@query("C6 C14", """select 'absent' as kind, 'no_such_column' as name union all
  select 'leaky', unnest(['category', 'category_specification'])""")
def column_report(spark: SparkSession, sf: str) -> DataFrame:
    rows = statements(spark, sf)
    features = set(fe.engineer(rows, SPEC, texts=False).columns)
    absent = quality.missing_columns(rows, [*rows.columns, "no_such_column"])
    leaky = [c for c in SPEC.leaky if c in rows.columns and c not in features]
    return spark.createDataFrame(
        [("absent", c) for c in absent] + [("leaky", c) for c in leaky], "kind string, name string"
    )


@query("C7", f"{ST} select row_id, application_date from st where {APP} is not null")
def dated_rows(spark: SparkSession, sf: str) -> DataFrame:
    return quality.drop_unparsed(statements(spark, sf), "application_date").select("row_id", "application_date")


@query("C11", f"""{ST} select round(avg(case when coalesce(incompatible_content_ground, '') <> '' then 1.0 else 0.0 end), 6)
  as incompatible_content_ground,
  round(avg(case when coalesce(incompatible_content_explanation, '') <> '' then 1.0 else 0.0 end), 6)
  as incompatible_content_explanation,
  round(avg(case when coalesce(decision_facts, '') <> '' then 1.0 else 0.0 end), 6) as decision_facts from st""")
def text_fill_rates(spark: SparkSession, sf: str) -> DataFrame:
    rows = statements(spark, sf)
    quality.require_fill(rows, SPEC.texts)
    return rounded(quality.fill_rate(rows, SPEC.texts))


@query("C12", f"""{ST} select round(avg({MON}), 6) as has_monetary_decision, round(avg({ACC}), 6) as has_account_decision,
  round(avg({PRO}), 6) as has_provision_decision,
  round(avg(case when ({VIS}) + ({MON}) + ({PRO}) + ({ACC}) > 1 then 1 else 0 end), 6)
  as is_multi_action_decision from st""")
def flag_prevalence(spark: SparkSession, sf: str) -> DataFrame:
    flags = ["has_monetary_decision", "has_account_decision", "has_provision_decision", "is_multi_action_decision"]
    return rounded(quality.prevalence(fe.derive(statements(spark, sf)), flags))


@query("C13", """select 'events' as source, count(*) - count(distinct event_id) as duplicates from events union all
  select 'lineitem', count(*) - count(distinct l_orderkey) from lineitem""")
def key_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    named = [("events", "event_id"), ("lineitem", "l_orderkey")]
    parts = [
        quality.key_dupes(table(spark, sf, t), k).select(F.lit(t).alias("source"), "duplicates") for t, k in named
    ]
    return parts[0].unionByName(parts[1])


@query("C15", f"""{ST} select (select coalesce(bool_or(created_at <> date_trunc('day', created_at)), false) from st)
  as created_at_has_time,
  (select coalesce(bool_or({APP} <> date_trunc('day', {APP})), false) from st) as application_date_has_time""")
def clock_time_gate(spark: SparkSession, sf: str) -> DataFrame:
    rows = statements(spark, sf).withColumn("applied", parse.lenient_timestamp("application_date"))
    found = (fe.any_clock_time(rows, "created_at"), fe.any_clock_time(rows, "applied"))
    return spark.createDataFrame([found], "created_at_has_time boolean, application_date_has_time boolean")


@query("C18", """select event_id from events
  where ts >= (select max(ts) - interval 4 hour from events)""")
def recent_history(spark: SparkSession, sf: str) -> DataFrame:
    return quality.trim_history(table(spark, sf, "events"), "ts", 4).select("event_id")


@query("C19", """select event_id from events
  where ts >= (select min(ts) + interval 3 hour from events)""")
def warmed_up(spark: SparkSession, sf: str) -> DataFrame:
    return quality.after_warmup(table(spark, sf, "events"), "ts", 3).select("event_id")


@query("T1 C1 C6 S1 S2 S3 S4 S5 S7 S8 S9 W1 W2 W3 J3", f"""{ST}, {FRAME_ROWS.replace("case when row_id % 5 = 0 or platform_name = 'p7' then 1 else 0 end", "0")},
  rate as (select p, avg(a) as r from fr where p is not null group by p)
  select st.row_id, {select_list({k: v for k, v in structured_sql().items()})},
  w.platform_volume_3h, w.platform_auto_fraction_3h, w.platform_content_type_div_3h,
  round(coalesce(rate.r, 0.0), 6) as platform_automation_rate
  from st join {rolling_sql('fr')} w on w.id = st.row_id left join rate on rate.p = st.platform_name""")
def engineered_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = statements(spark, sf)
    rates = group_rate(rows, "platform_name", scalars.yes_flag("automated_detection"), SPEC.rate)
    return rounded(fe.engineer(rows, SPEC, rates=rates, texts=False))


@query("T1 C7 C8 W5 W6 W7 W10 G3 J3", f"""{ST},
  t0 as (select *, replace(category, 'STATEMENT_CATEGORY_', '') as target, {APP} as d from st where {APP} is not null),
  t1 as (select * from t0 where target in (select target from t0 group by target having count(*) > 20)),
  t2 as (select *, row_number() over (order by d, row_id) > floor((select count(*) from t1) * 0.8) as is_test from t1),
  fr as (select row_id as id, platform_name as p, epoch_us(created_at) as us,
    case when lower(coalesce(automated_detection, '')) = 'yes' then 1 else 0 end as a,
    coalesce({list_first_sql('content_type')}, 'UNKNOWN') as kind, cast(is_test as int) as t from t2),
  rate as (select p, avg(a) as r from fr where p is not null and t = 0 group by p)
  select t2.row_id, t2.target, t2.is_test, w.platform_volume_3h, w.platform_auto_fraction_3h,
  w.platform_content_type_div_3h, round(coalesce(rate.r, 0.0), 6) as platform_automation_rate
  from t2 join {rolling_sql('fr')} w on w.id = t2.row_id left join rate on rate.p = t2.platform_name""")
def training_features(spark: SparkSession, sf: str) -> DataFrame:
    rows, _ = fe.training_rows(statements(spark, sf), SPEC, texts=False)
    return rounded(rows.select("row_id", "target", "is_test", *SPEC.rolling, SPEC.rate))
