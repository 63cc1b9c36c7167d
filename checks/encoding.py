"""Encoders and TF-IDF."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.base import query, rounded, table
from tidemark.operators import encode, models, tfidf

# Parts: brand and type as categories, three size classes as label, every third part held out.
PART = """p as (select p_partkey, p_brand, p_type, p_size, p_retailprice, cast(p_partkey % 5 as int) as fold,
  case when p_size < 15 then 0 when p_size < 35 then 1 else 2 end as cls, p_partkey % 3 = 0 as is_test from part)"""


def parts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr(
        "p_partkey", "p_brand", "p_type", "p_size", "p_retailprice", "cast(p_partkey % 5 as int) as fold",
        "case when p_size < 15 then 0 when p_size < 35 then 1 else 2 end as cls", "p_partkey % 3 = 0 as is_test",
    )


@query("E3", f"""with {PART}, f as (select * from p where not is_test and p_brand <> 'Brand#3'),
  b as (select p_brand, row_number() over (order by p_brand) - 1 as code from (select distinct p_brand from f)),
  t as (select p_type, row_number() over (order by p_type) - 1 as code from (select distinct p_type from f))
  select p_partkey, cast(coalesce(b.code, -1) as int) as p_brand, cast(coalesce(t.code, -1) as int) as p_type
  from p left join b using (p_brand) left join t using (p_type)""")
def ordinal_codes(spark: SparkSession, sf: str) -> DataFrame:
    rows = parts(spark, sf)
    codes = encode.ordinal_fit(rows.where("not is_test and p_brand <> 'Brand#3'"), ["p_brand", "p_type"])
    return encode.ordinal_apply(rows, codes, ["p_brand", "p_type"]).select("p_partkey", "p_brand", "p_type")


def smooth(n: str, hits: str, prior: str) -> str:
    v = f"({prior}) * (1 - ({prior}))"
    p = f"(({hits}) / cast({n} as double))"
    lam = f"(({n}) * {v} / (({n}) * {v} + {p} * (1 - {p})))"
    return (f"case when coalesce({n}, 0) > 0 and ({n}) * {v} + {p} * (1 - {p}) > 0 "
            f"then {lam} * {p} + (1 - {lam}) * ({prior}) else {prior} end")


def long_form(df: DataFrame, cols: list[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}_te").alias("enc")) for c in cols])
    return df.select("p_partkey", F.inline(pairs)).select("p_partkey", "feature", F.posexplode("enc").alias("cls", "enc"))


@query("E4", f"""with {PART}, f as (select * from p where not is_test and p_brand <> 'Brand#3'),
  lf as (select 'p_brand' as feature, p_brand as value, cls from f union all select 'p_type', p_type, cls from f),
  k as (select distinct cls from f),
  pr as (select k.cls, (select count(*) from f where f.cls = k.cls) / (select count(*) from f) as prior from k),
  vc as (select feature, value, count(*) as n from lf group by 1, 2),
  hc as (select feature, value, cls, count(*) as h from lf group by 1, 2, 3),
  rows as (select p_partkey, 'p_brand' as feature, p_brand as value from p union all select p_partkey, 'p_type', p_type from p)
  select p_partkey, rows.feature, pr.cls, round({smooth('vc.n', 'coalesce(hc.h, 0)', 'pr.prior')}, 6) as enc
  from rows cross join pr left join vc on vc.feature = rows.feature and vc.value = rows.value
  left join hc on hc.feature = rows.feature and hc.value = rows.value and hc.cls = pr.cls""")
def target_encoding(spark: SparkSession, sf: str) -> DataFrame:
    rows, cols = parts(spark, sf), ["p_brand", "p_type"]
    train = rows.where("not is_test and p_brand <> 'Brand#3'")
    tables = encode.target_fit(train, cols, "cls", 3, F.col("fold"))
    return rounded(long_form(encode.target_apply(rows, tables, cols), cols))


@query("E5", f"""with {PART}, lf as (select 'p_brand' as feature, p_brand as value, cls, fold, p_partkey from p
    union all select 'p_type', p_type, cls, fold, p_partkey from p),
  k as (select distinct cls from p), folds as (select distinct fold from p),
  pr as (select fold, cls, (select count(*) from p where p.cls = k.cls and p.fold <> folds.fold)
    / (select count(*) from p where p.fold <> folds.fold) as prior from k, folds),
  vc as (select feature, value, folds.fold, count(*) as n from lf, folds where lf.fold <> folds.fold group by 1, 2, 3),
  hc as (select feature, value, folds.fold, cls, count(*) as h from lf, folds where lf.fold <> folds.fold group by 1, 2, 3, 4)
  select p_partkey, lf.feature, pr.cls, round({smooth('vc.n', 'coalesce(hc.h, 0)', 'pr.prior')}, 6) as enc
  from lf join pr on pr.fold = lf.fold left join vc on vc.feature = lf.feature and vc.value = lf.value and vc.fold = lf.fold
  left join hc on hc.feature = lf.feature and hc.value = lf.value and hc.fold = lf.fold and hc.cls = pr.cls""")
def target_encoding_cross_fit(spark: SparkSession, sf: str) -> DataFrame:
    rows, cols = parts(spark, sf), ["p_brand", "p_type"]
    tables = encode.target_fit(rows, cols, "cls", 3, F.col("fold"))
    return rounded(long_form(encode.target_cross_fit(rows, tables, cols, F.col("fold")), cols))


@query("E6 E7", """select p_partkey, round((p_size - (select avg(p_size) from part)) / (select stddev_pop(p_size) from part), 6)
  as p_size, round((p_retailprice - (select avg(p_retailprice) from part)) / (select stddev_pop(p_retailprice) from part), 6)
  as p_retailprice, p_type from part""")
def standardised_numbers(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice", "p_type")
    return rounded(encode.standardise(rows, ["p_size", "p_retailprice"]))


def tfidf_sql(source: str, key: str, text: str, terms: int, select: str) -> str:
    return rf"""with w as (select {key} as k, regexp_extract_all(lower(coalesce({text}, '')), '[\p{{L}}\p{{N}}_]{{2,}}') as t from {source}),
  tok as (select k, unnest(t) as term, generate_subscripts(t, 1) as i from w),
  grams as (select k, term from tok union all
    select k, term || ' ' || lead(term) over (partition by k order by i) from tok
    qualify lead(term) over (partition by k order by i) is not null),
  tf as (select k, term, count(*) as tf from grams group by 1, 2),
  st as (select term, count(*) as df, sum(tf) as total from tf group by term having count(*) >= 2),
  top as (select term, df from st order by total desc, term limit {terms}),
  v as (select term, df, ln((1.0 + (select count(*) from {source})) / (1.0 + df)) + 1.0 as idf,
    cast(row_number() over (order by term) - 1 as int) as idx from top),
  raw as (select k, term, idx, (1 + ln(tf)) * idf as w from tf join v using (term)) {select}"""


@query("E8", tfidf_sql("documents", "doc_id", "text", 5000,
    "select term, idx, df, round(idf, 6) as idf from v"))
def tfidf_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(tfidf.tfidf_fit(table(spark, sf, "documents"), "doc_id", "text", 5000))


@query("E8", tfidf_sql("documents", "doc_id", "text", 3000,
    "select k as doc_id, term, idx, round(w / sqrt(sum(w * w) over (partition by k)), 6) as weight from raw"))
def tfidf_weights(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return rounded(tfidf.tfidf_apply(docs, tfidf.tfidf_fit(docs, "doc_id", "text", 3000), "doc_id", "text"))


@query("E8 E9", tfidf_sql("conversations", "concat(conv_id, '/', turn)", "text", 500, """, u as (select k, idx,
    w / sqrt(sum(w * w) over (partition by k)) as weight from raw)
  select concat(conv_id, '/', turn) as k, 501 as size, count(idx) + case when turn <> 0 then 1 else 0 end as filled,
  round(coalesce(sum(weight), 0) + turn, 6) as total
  from conversations left join u on u.k = concat(conv_id, '/', turn) group by conv_id, turn"""))
def tfidf_assembled(spark: SparkSession, sf: str) -> DataFrame:
    """A number and a sparse text vector in one vector; a text without known terms is all zero."""
    rows = table(spark, sf, "conversations").withColumn("k", F.concat("conv_id", F.lit("/"), "turn"))
    vocabulary = tfidf.tfidf_fit(rows, "k", "text", 500)
    vectors = tfidf.tfidf_vectors(rows, vocabulary, "k", "text", "text_tfidf")
    joined = models.encode_features(vectors.withColumn("turn", F.col("turn").cast("double")), ["turn", "text_tfidf"])
    entries = vector_to_array("features")
    return rounded(joined.select(
        "k", F.size(entries).alias("size"),
        F.size(F.filter(entries, lambda x: x != 0)).cast("long").alias("filled"),
        F.aggregate(entries, F.lit(0.0), lambda a, x: a + x).alias("total"),
    ))
