"""Reading dumps: single files, drifting sets of files, day folders and their last chunks."""

from __future__ import annotations

import csv
import datetime as dt
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from tidemark.sources.schema import align, merge_schemas

EXTENSIONS = (".parquet", ".csv", ".csv.gz")


def discover(spark: SparkSession, root: str, extensions: Sequence[str] = EXTENSIONS) -> DataFrame:
    """(path, bytes) of the data files under `root`, at any depth, by path. Hidden files are left out."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", F.col("length").alias("bytes"))  # the content column is never read
    )
    name = F.lower("path")
    wanted = reduce(Column.__or__, [name.endswith(e) for e in extensions])
    return listing.where(wanted).orderBy("path")


def _by_kind(paths: Sequence[str]) -> dict[str, list[str]]:
    kinds: dict[str, list[str]] = defaultdict(list)
    for path in paths:
        lower = path.lower()
        kinds["gzip" if lower.endswith(".gz") else "csv" if lower.endswith(".csv") else "parquet"].append(path)
    return kinds


def _parquet_groups(spark: SparkSession, paths: list[str]) -> dict[str, tuple[T.StructType, list[str]]]:
    """Files by schema. Footers are merged by a Spark job; only a list that conflicts is halved and retried."""
    try:
        merged = spark.read.option("mergeSchema", "true").parquet(*paths).schema
        return {merged.json(): (merged, paths)}
    except (PySparkException, Py4JJavaError) as error:
        if len(paths) == 1 or "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    half = len(paths) // 2
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for part in (paths[:half], paths[half:]):
        for name, (schema, members) in _parquet_groups(spark, part).items():
            groups[name] = (schema, groups.get(name, (schema, []))[1] + members)
    return groups


# Quotes inside quoted values are doubled; a backslash is an ordinary character.
CSV = {"header": "true", "quote": '"', "escape": '"'}


def _csv_groups(spark: SparkSession, paths: list[str]) -> list[tuple[list[str], list[str]]]:
    """(column names, files) by header line: columns are matched by place, so only equal headers may share a scan."""
    lines = spark.read.text(paths).select(
        "value",
        F.monotonically_increasing_id().alias("at"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    heads = lines.where("start = 0").groupBy("path").agg(F.min_by("value", "at").alias("header"))
    groups: dict[str, list[str]] = defaultdict(list)
    for row in heads.orderBy("path").collect():  # one row per file
        groups[row["header"]].append(row["path"])
    return [(next(csv.reader([header or ""])), members) for header, members in groups.items()]


def read_statements(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None, multiline: bool = False
) -> DataFrame:
    """One DataFrame over Parquet, CSV and gzip CSV files whose schemas may differ.

    The target schema is known before any row is read, so the result is one lazy scan per distinct schema and
    nothing is rewritten. A single Parquet file is returned as it is. With `schema` no type is inferred: the CSV
    reader gets each column's type, so `007` stays text where text is asked for. `multiline` allows line breaks inside
    quoted CSV values; such files are not split.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    kinds = _by_kind(paths)
    frames: list[DataFrame] = []
    if kinds["parquet"]:
        for own, members in _parquet_groups(spark, kinds["parquet"]).values():
            frames.append(spark.read.schema(own).parquet(*members))
    for kind in ("csv", "gzip"):
        for names, members in _csv_groups(spark, kinds[kind]) if kinds[kind] else []:
            reader = spark.read.options(**CSV, multiLine=str(multiline).lower())
            if schema is None:
                reader = reader.option("inferSchema", "true")
            else:
                known = {f.name: f.dataType for f in schema}
                reader = reader.schema(T.StructType([T.StructField(n, known.get(n, T.StringType())) for n in names]))
            frame = reader.csv(members)
            # A gzip file cannot be split: one task reads it, then its rows are spread.
            frames.append(frame.repartition(spark.sparkContext.defaultParallelism) if kind == "gzip" else frame)
    if not frames:
        raise FileNotFoundError("no data files given")
    if len(frames) == 1 and schema is None:
        return frames[0]
    target = schema or merge_schemas([f.schema for f in frames])
    return reduce(DataFrame.unionByName, [align(f, target) for f in frames])


def count_rows(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, rows) of each file; a file that cannot be read has 0 rows."""
    kinds = _by_kind(paths)
    parts = []
    if kinds["parquet"]:
        empty = T.StructType([])
        parts.append(spark.read.option("ignoreCorruptFiles", "true").schema(empty).parquet(*kinds["parquet"]))
    for kind in ("csv", "gzip"):
        if kinds[kind]:
            reader = spark.read.options(**CSV, ignoreCorruptFiles="true")
            parts.append(reader.schema("line string").csv(kinds[kind]))
    counted = [
        p.select(_plain("_metadata.file_path").alias("path")).groupBy("path").agg(F.count("*").alias("rows"))
        for p in parts
    ]
    asked = spark.read.format("binaryFile").load(list(paths)).select(_plain("path").alias("path"))
    return (
        asked.join(reduce(DataFrame.unionByName, counted), "path", "left")
        .select("path", F.coalesce("rows", F.lit(0)).alias("rows"))
    )


def _plain(path: str) -> Column:
    """Local paths are listed with one slash after the scheme and scanned with three."""
    return F.regexp_replace(path, "^file:/+", "file:/")


# Lists the formats of the older reader, without Parquet: only the newer one answers aggregates from footers.
FOOTERS = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_aggregate(spark: SparkSession, path: str | Sequence[str], *aggregates: Column) -> tuple[Row, str]:
    """Counts, and minima and maxima of plain columns, of Parquet files, with the plan that gave them.

    The aggregates are pushed into the scan, which then reads footers and no row; the plan names them under
    `PushedAggregation`. Other aggregates are computed from the rows as usual.
    """
    before = {k: spark.conf.get(k, None) for k in FOOTERS}
    for k, v in FOOTERS.items():
        spark.conf.set(k, v)
    try:
        out = spark.read.parquet(*([path] if isinstance(path, str) else path)).agg(*aggregates)
        plan = out._jdf.queryExecution().executedPlan().toString()
        return out.first(), plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def estimate_rows(spark: SparkSession, path: str | Sequence[str]) -> int:
    """Rows of Parquet files, exact and from their footers alone."""
    return footer_aggregate(spark, path, F.count(F.lit(1)).alias("n"))[0]["n"]


# --- daily dumps -----------------------------------------------------------------------


def read_dump(spark: SparkSession, root: str, start: dt.date, end: dt.date, day: str = "day") -> DataFrame:
    """Rows of a `day=`-partitioned dump between two dates, both included. Missing days are simply absent."""
    return days_between(spark.read.parquet(root), start, end, day)


def days_between(df: DataFrame, start: dt.date, end: dt.date, day: str = "day") -> DataFrame:
    if start > end:
        raise ValueError(f"start {start} lies after end {end}")
    return df.where(F.col(day).between(F.lit(start), F.lit(end)))


def latest_day(df: DataFrame, today: dt.date, lookback: int = 10, day: str = "day") -> dt.date:
    """Last day with rows among the `lookback` days before `today`."""
    window = days_between(df, today - dt.timedelta(days=lookback), today - dt.timedelta(days=1), day)
    found = window.agg(F.max(day)).first()[0]
    if found is None:
        raise LookupError(f"no dump in the {lookback} days before {today}")
    return found


def tail_chunks(df: DataFrame, n: int, chunk: str = "chunk") -> DataFrame:
    """Rows of the last `n` chunks by name. The names become a literal list, so other files are not read."""
    names = [r[0] for r in df.select(chunk).distinct().orderBy(F.desc(chunk)).limit(n).collect()]
    return df.where(F.col(chunk).isin(names))


def tail_for_span(
    df: DataFrame, ts: str, hours: float, start: int = 2, step: int = 2, cap: int = 20, chunk: str = "chunk"
) -> DataFrame:
    """Rows of the shortest tail (start, start + step, ... up to cap chunks) that spans at least `hours`."""
    spans = (
        tail_chunks(df, max(cap, start), chunk)
        .groupBy(chunk)
        .agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
        .orderBy(F.desc(chunk))
        .collect()  # at most `cap` rows
    )
    size = start
    while size < cap:
        lows = [r["lo"] for r in spans[:size] if r["lo"] is not None]
        highs = [r["hi"] for r in spans[:size] if r["hi"] is not None]
        if lows and (max(highs) - min(lows)).total_seconds() >= hours * 3600:
            break
        size += step
    return tail_chunks(df, size, chunk)


def time_span(df: DataFrame, ts: str) -> DataFrame:
    """First and last timestamp and the hours between them."""
    lo, hi = F.min(ts), F.max(ts)
    hours = (F.unix_micros(hi.cast("timestamp")) - F.unix_micros(lo.cast("timestamp"))) / 3.6e9
    return df.agg(lo.alias("first_ts"), hi.alias("last_ts"), F.coalesce(hours, F.lit(0.0)).alias("span_hours"))


def write_statements(df: DataFrame, path: str, by: str | None = "day", mode: str = "overwrite") -> None:
    """Write Parquet; partitions are balanced at run time, so a huge day is split and small ones share a task."""
    if by is None:
        df.write.mode(mode).parquet(path)
        return
    df.hint("rebalance", by).write.mode(mode).partitionBy(by).parquet(path)
