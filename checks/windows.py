"""Rolling statistics and the chronological split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.base import list_first_sql, query, rounded, statements, table
from checks.sqltext import APP, FRAME_ROWS, IS_TEST, ST, rolling_sql
from tidemark.functions import parse, scalars
from tidemark.operators.rolling import rolling
from tidemark.operators.split import chrono_split
from tidemark.plans import features as fe

NO_TEST = FRAME_ROWS.replace("case when row_id % 5 = 0 or platform_name = 'p7' then 1 else 0 end", "0")
STATS = ["platform_volume_3h", "platform_auto_fraction_3h", "platform_content_type_div_3h"]


def frame_rows(spark: SparkSession, sf: str) -> DataFrame:
    return statements(spark, sf).select(
        "row_id", "platform_name", "created_at",
        scalars.yes_flag("automated_detection").alias("auto"),
        parse.list_first("content_type").alias("kind"),
        F.expr(IS_TEST).alias("is_test"),
    )


def stats(df: DataFrame, **options) -> DataFrame:
    out = rolling(df, "platform_name", "created_at", "row_id", "auto", "kind", **options)
    return rounded(out.select(F.col("row_id").alias("id"), *STATS))


@query("W1 W2 W3", """with e as (select event_id as id, user_id % 20 as p, ts, event_type from events)
  select id, count(*) over pri - count(*) over old as volume,
  round(coalesce((coalesce(sum(case when event_type = 'click' then 1 else 0 end) over pri, 0)
    - coalesce(sum(case when event_type = 'click' then 1 else 0 end) over old, 0))
    / nullif(cast(count(*) over pri - count(*) over old as double), 0), 0), 6) as auto_fraction,
  case when count(*) over pri - count(*) over old = 0 then 1 else """ + " + ".join(
    f"case when count(case when event_type = '{t}' then 1 end) over pri "
    f"- count(case when event_type = '{t}' then 1 end) over old > 0 then 1 else 0 end"
    for t in ("click", "error", "purchase", "signup", "view")
) + """ end as diversity
  from e window pri as (partition by p order by ts, id rows between unbounded preceding and 1 preceding),
  old as (partition by p order by ts range between unbounded preceding and interval '3 hours 1 microsecond' preceding)""")
def rolling_events(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        F.col("event_id").alias("id"), (F.col("user_id") % 20).alias("p"), "ts", "event_type"
    )
    out = rolling(events, "p", "ts", "id", F.col("event_type") == "click", "event_type", prefix="")
    return rounded(out.select(
        "id", F.col("volume_3h").alias("volume"), F.col("auto_fraction_3h").alias("auto_fraction"),
        F.col("content_type_div_3h").cast("int").alias("diversity"),
    ))


@query("W1 W2 W3 W9", f"{ST}, {NO_TEST} select * from {rolling_sql('fr')}")
def rolling_statements(spark: SparkSession, sf: str) -> DataFrame:
    return stats(frame_rows(spark, sf))


@query("W5 W6 W7 W9 J6", f"{ST}, {FRAME_ROWS} select * from {rolling_sql('fr')}")
def rolling_all_prior(spark: SparkSession, sf: str) -> DataFrame:
    return stats(frame_rows(spark, sf), is_test="is_test")


@query("W4 W6 W7 J6", f"{ST}, {FRAME_ROWS} select * from {rolling_sql('fr', 'train_only')}")
def rolling_train_only(spark: SparkSession, sf: str) -> DataFrame:
    return stats(frame_rows(spark, sf), is_test="is_test", mode="train_only")


@query("W4 W5 W6 W7", f"""{ST}, {FRAME_ROWS.replace("epoch_us(created_at)", "epoch_us(date_trunc('hour', created_at))")}
  select * from {rolling_sql('fr')}""")
def rolling_hot_group(spark: SparkSession, sf: str) -> DataFrame:
    """Hour-long ties on a platform with a third of the rows, with groups cut into small cells."""
    rows = frame_rows(spark, sf).withColumn("created_at", F.date_trunc("hour", "created_at"))
    return stats(rows, is_test="is_test", max_rows=64)


@query("W8 O4", f"""{ST}, {NO_TEST} select w.* from {rolling_sql('fr')} w join fr using (id)
  where fr.us >= epoch_us(timestamp '2024-01-15 00:00:00')""")
def rolling_warm_start(spark: SparkSession, sf: str) -> DataFrame:
    rows = frame_rows(spark, sf)
    start = F.lit("2024-01-15 00:00:00").cast("timestamp")
    batch = rows.where(F.col("created_at") >= start)
    # The history holds the start of the batch too, as a stream would hand it over; those rows count once.
    history = rows.where(F.col("created_at") < start + F.expr("interval 12 hours"))
    return stats(batch, history=history)


@query("W9 C15", f"{ST} select row_id as id, 0 as volume, cast(0.0 as double) as fraction, 1 as diversity from st")
def rolling_day_precision(spark: SparkSession, sf: str) -> DataFrame:
    rows = fe.derive(statements(spark, sf).drop("created_at"))
    out = fe.with_rolling(rows)
    return out.select(
        F.col("row_id").alias("id"), F.col("platform_volume_3h").cast("int").alias("volume"),
        F.col("platform_auto_fraction_3h").alias("fraction"),
        F.col("platform_content_type_div_3h").cast("int").alias("diversity"),
    )


@query("W10", f"""{ST}, d as (select row_id, {APP} as dt from st where {APP} is not null)
  select row_id, row_number() over (order by dt, row_id) > floor((select count(*) from d) * 0.8) as is_test from d""")
def split_by_date(spark: SparkSession, sf: str) -> DataFrame:
    rows = statements(spark, sf).select("row_id", parse.lenient_timestamp("application_date").alias("at"))
    return chrono_split(rows.where("at is not null"), "at", "row_id").select("row_id", "is_test")


@query("W10", """select event_id, row_number() over (order by ts, event_id)
  > floor((select count(*) from events) * 0.7) as is_test from events""")
def split_by_time(spark: SparkSession, sf: str) -> DataFrame:
    return chrono_split(table(spark, sf, "events"), "ts", "event_id", 0.3).select("event_id", "is_test")


@query("W10", f"""{ST}, d as (select row_id, {APP} as dt from st where {APP} is not null)
  select row_id, row_number() over (order by dt, row_id) > floor((select count(*) from d) * 0.8) as is_test from d""")
def split_crowded_day(spark: SparkSession, sf: str) -> DataFrame:
    """The same split found by narrowing down, as for a day too full to sort; all rows of a day share one moment."""
    rows = statements(spark, sf).select("row_id", parse.lenient_timestamp("application_date").alias("dt"))
    return chrono_split(rows.where("dt is not null"), "dt", "row_id", sortable=10).select("row_id", "is_test")
