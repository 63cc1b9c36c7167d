"""Keyed feature groups, their joined view, metadata, scored rows and the model registry."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tidemark.functions.parse import lenient_timestamp
from tidemark.sources import versions


def first_by_key(df: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first by `order`, or by all columns where no order is given.

    The rank filter is applied before the shuffle too (a window group limit), so a key with very many copies
    sends at most one row per task.
    """
    by = list(order) or [c for c in df.columns if c != key]
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*by))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def group_path(root: str, name: str, version: int) -> str:
    return f"{root.rstrip('/')}/{name}/version={version}"


def write_feature_group(
    df: DataFrame,
    root: str,
    name: str,
    version: int,
    key: str,
    event_time: str | None = None,
    order: Sequence[str] = (),
    buckets: int | None = None,
) -> str:
    """Replace a feature group: unique keys, parsed event time, 64-bit integers, Parquet.

    The rows become the newest version of the group's folder, at once for all readers; see `versions`. With `buckets` it
    becomes a catalog table bucketed and sorted by key, so that joining groups of one bucket count needs no shuffle;
    such a table is dropped and made anew. Returns the path of the rows, or the table name.
    """
    rows = first_by_key(df, key, order)
    if event_time:
        rows = rows.withColumn(event_time, lenient_timestamp(event_time))
    rows = widen_integers(rows)
    path = group_path(root, name, version)
    if buckets:
        table = f"{name}_v{version}"
        rows.sparkSession.sql(f"DROP TABLE IF EXISTS `{table}`")
        writer = rows.repartition(buckets, key).write.mode("overwrite").option("path", path)
        writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
        return table
    return versions.commit(rows.sparkSession, path, lambda p: rows.write.parquet(p))["path"]


def read_feature_group(spark: SparkSession, root: str, name: str, version: int) -> DataFrame:
    return spark.read.parquet(_newest(spark, group_path(root, name, version))["path"])


def _newest(spark: SparkSession, root: str) -> dict:
    found = versions.latest(spark, root)
    if found is None:
        raise FileNotFoundError(f"nothing was committed under {root}")
    return found


def widen_integers(df: DataFrame) -> DataFrame:
    """Small integer types as bigint."""
    small = (T.ByteType, T.ShortType, T.IntegerType)
    return df.withColumns(
        {f.name: F.col(f.name).cast("bigint") for f in df.schema if isinstance(f.dataType, small)}
    )


def feature_view(base: DataFrame, others: Sequence[DataFrame], key: str) -> DataFrame:
    """Left join of groups on their unique key; every row of `base` stays, with its key and label."""
    view = base
    for other in others:
        view = view.join(other, key, "left")
    return view


def write_feature_store(
    rows: DataFrame,
    root: str,
    name: str,
    version: int,
    key: str,
    texts: Sequence[str],
    event_time: str | None = None,
    labels: DataFrame | None = None,
    settings: Mapping | None = None,
    order: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """The whole stage: a structured group, one group for each text column, metadata, and the view that joins them.

    Groups are called `<name>_struct` and `<name>_<text column>`; the metadata names them. Returns the view.
    """
    spark = rows.sparkSession
    base = [c for c in rows.columns if c not in texts]
    parts = {f"{name}_struct": base} | {f"{name}_{t}": [key, t] for t in texts}
    groups = []
    for group, columns in parts.items():
        known = [c for c in order if c in columns]
        own = rows.select(*columns) if group.endswith("_struct") else rows.where(F.col(columns[1]).isNotNull()).select(*columns)
        time = event_time if event_time in columns else None
        where = write_feature_group(own, root, group, version, key, time, known, buckets)
        groups.append(spark.table(where) if buckets else spark.read.parquet(where))
    listed = {"key": key, "version": version, "groups": list(parts), "features": [c for c in base if c != key], "texts": list(texts)}
    none = spark.createDataFrame([], "label string, label_id int")
    write_metadata(spark, f"{root}/{name}_metadata", labels if labels is not None else none, listed | dict(settings or {}))
    return feature_view(groups[0], groups[1:], key)


def backfill(df: DataFrame, source: DataFrame, key: str, column: str) -> DataFrame:
    """Add `column` from a group that has it."""
    return df.join(source.select(key, column), key, "left")


def write_metadata(spark: SparkSession, root: str, labels: DataFrame, settings: Mapping) -> None:
    """The label table and the settings (feature lists, names, versions), together as one version."""
    versions.commit(spark, root, lambda p: labels.write.parquet(p), {"settings": dict(settings)})


def read_metadata(spark: SparkSession, root: str) -> tuple[DataFrame, dict]:
    found = _newest(spark, root)
    return spark.read.parquet(found["path"]), found["settings"]


def write_scored(df: DataFrame, path: str, batch_id: int | None = None, form: str = "parquet") -> None:
    """Write scored rows; a batch replaces only itself, so a replayed batch leaves no copies."""
    target = path if batch_id is None else f"{path}/batch_id={batch_id}"
    writer = df.write.mode("overwrite").format(form)
    (writer.option("header", "true") if form == "csv" else writer).save(target)


# --- models ----------------------------------------------------------------------------

REGISTRY_SCHEMA = "name string, version int, metric string, value double, path string"


def save_model(model, metrics: Mapping[str, float], root: str, name: str, spark: SparkSession) -> int:
    """Save a fitted model under the next version, with its metrics; both appear at once.

    `model` is an ML model or a `training.Bundle`, which brings its encoders, vocabularies and class labels with it.
    """
    write = getattr(model, "write_parts", None) or model.save
    info = {"name": name, "kind": type(model).__name__, "metrics": {k: float(v) for k, v in metrics.items()}}
    return versions.commit(spark, f"{root}/models/{name}", write, info)["version"]


def read_registry(spark: SparkSession, root: str) -> DataFrame:
    """(name, version, metric, value, path) of all saved models, empty where nothing was saved yet."""
    form = "name string, version int, path string, metrics map<string,double>"
    try:
        lines = spark.read.text(f"{root}/models/*/versions/*/part-*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], REGISTRY_SCHEMA)
    found = lines.select(F.from_json("value", form).alias("m"))
    return found.select("m.name", "m.version", F.explode("m.metrics").alias("metric", "value"), "m.path")


def best_model(registry: DataFrame, metric: str, direction: str = "max") -> DataFrame:
    """The registry row with the best value of `metric`; ties go by name, then to the newest version."""
    value = F.desc("value") if direction == "max" else F.asc("value")
    return registry.where(F.col("metric") == metric).orderBy(value, "name", F.desc("version")).limit(1)
