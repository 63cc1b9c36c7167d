"""Registry of queries with their SQL, and statement rows derived from the `events` table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.session import tune

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None
    covers: tuple[str, ...]  # operator ids of the survey


REGISTRY: dict[str, Entry] = {}


def query(covers: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL it must agree with."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        if fn.__name__ in REGISTRY:
            raise ValueError(f"{fn.__name__} is registered twice")
        REGISTRY[fn.__name__] = Entry(run, sql, tuple(covers.split()))
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that both engines agree on sums added up in another order."""
    doubles = [f.name for f in df.schema if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


# Statement columns as expressions that both SQL dialects read alike.
STATEMENT_COLUMNS = {
    "row_id": "event_id",
    "uuid": "concat('u', cast(event_id as string))",
    "category": (
        "concat('STATEMENT_CATEGORY_', case when event_id % 1000 = 0 then 'RARE' "
        "when event_type = 'view' then 'OTHER_VIOLATION_TC' else concat('ON_', upper(event_type)) end)"
    ),
    "category_specification": "concat('ON_', upper(event_type))",
    "platform_name": (
        "case when user_id = 149 then null when user_id < 50 then 'p0' "
        "else concat('p', cast(user_id % 20 as string)) end"
    ),
    "source_type": "case event_id % 6 when 0 then null when 1 then 'FLAGGER' when 2 then 'USER' else 'OWN' end",
    "account_type": "case event_id % 4 when 0 then null when 1 then 'BUSINESS' else 'PRIVATE' end",
    "content_language": "case user_id % 7 when 0 then null when 1 then 'de' when 2 then 'fr' else 'en' end",
    "decision_ground": "case event_id % 3 when 0 then 'ILLEGAL' else 'INCOMPATIBLE' end",
    "automated_detection": (
        "case when event_id % 13 = 0 then null when event_type = 'click' then 'Yes' else 'No' end"
    ),
    "automated_decision": "case event_id % 5 when 0 then null when 1 then 'FULLY' else 'NOT' end",
    "incompatible_content_illegal": "case event_id % 7 when 0 then null when 1 then 'Yes' else 'No' end",
    "content_type": (
        "case event_id % 9 when 0 then null when 1 then '[]' when 2 then 'oops' "
        "when 3 then concat('[\"', event_type, '\", \"x\"]') when 4 then concat('[''', event_type, ''', None]') "
        "when 5 then concat('[''', event_type, ''',]') when 6 then concat('(''', event_type, ''',)') "
        "else concat('['' ', event_type, ' '', ''x'', ''y'']') end"
    ),
    "territorial_scope": (
        "case event_id % 5 when 0 then null when 1 then '[\"AT\"]' when 2 then '[\"DE\", \"FR\"]' "
        "when 3 then '[\"AT\", \"DE\", \"FR\"]' else '[]' end"
    ),
    "decision_visibility": (
        "case event_id % 4 when 0 then null when 1 then '[\"DISABLED\"]' when 2 then '[]' "
        "else '[\"DEMOTED\", \"LABELLED\"]' end"
    ),
    "decision_monetary": "case when value < 20 then null else 'Y' end",
    "decision_provision": "case when value < 50 then null else 'Y' end",
    "decision_account": "case when value < 100 then null else 'Y' end",
    "application_date": "case when event_id % 97 = 0 then 'bad' else cast(cast(ts as date) as string) end",
    "content_date": (
        "case when event_id % 89 = 0 then null "
        "else concat(cast(cast(ts as date) - cast(event_id % 40 as int) as string), ' 13:00:00') end"
    ),
    "created_at": "case when event_id % 101 = 0 then null else ts end",
    "incompatible_content_ground": (
        "case when event_id % 50 = 0 then null else concat(event_type, ' by user ', cast(user_id % 20 as string)) end"
    ),
    "incompatible_content_explanation": "concat('seen ', event_type, ' near ', props)",
    "decision_facts": "case when event_id % 17 = 0 then null else props end",
}
# Columns with one dirty value each that a date filter or key check can find.
STATEMENTS_SQL = "select " + ", ".join(f"{e} as {n}" for n, e in STATEMENT_COLUMNS.items()) + " from events"


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statement rows in the raw schema, derived from `events`."""
    return table(spark, sf_dir, "events").selectExpr(*[f"{e} as {n}" for n, e in STATEMENT_COLUMNS.items()])


# Fixed predictions for the metric queries: one in four rows says 'view', a few have no label or failed.
PREDICTION_COLUMNS = {
    "row_id": "event_id",
    "ts": "ts",
    "actual": "case when event_id % 11 = 0 then null else event_type end",
    "predicted": (
        "case when event_id % 53 = 0 then 'ERROR' when event_id % 4 = 0 then 'view' "
        "when event_id % 10 = 3 and event_type = 'error' then 'signup' else event_type end"
    ),
}
PREDICTIONS_SQL = "select " + ", ".join(f"{e} as {n}" for n, e in PREDICTION_COLUMNS.items()) + " from events"


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*[f"{e} as {n}" for n, e in PREDICTION_COLUMNS.items()])


def list_items_sql(col: str) -> str:
    """Items of a bracketed list string, in the other engine's terms."""
    pattern = "''[^'']*''|\"[^\"]*\"|None"
    return f"case when regexp_full_match({col}, '\\s*\\[.*\\]\\s*') then regexp_extract_all({col}, '{pattern}') end"


def list_first_sql(col: str) -> str:
    items = list_items_sql(col)
    return f"trim(trim(({items})[1], '''\"'))"


def list_count_sql(col: str) -> str:
    return f"cast(coalesce(len({list_items_sql(col)}), 0) as int)"
