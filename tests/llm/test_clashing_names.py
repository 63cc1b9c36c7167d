"""Columns of the input whose names the operators use inside come back as they were."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, license_scan, near_dup, quality_rules, secret_scan, sentence_pieces

FOLDER = Path(license_scan.__file__).parent
# Every name that any operator gives to a column, as it stands in the sources.
NAMES = sorted(
    {n for f in FOLDER.glob("*.py") for n in re.findall(r"""alias\("(\w+)"|withColumn\("(\w+)"|^\s+"(\w+)": F\.""", f.read_text(), re.M) for n in n if n}
    | {"_id", "_digest", "_row", "_text", "_words", "_key", "_spans", "_lines", "_n", "_path", "_dir", "own", "row", "text_a", "node", "root", "band"}
)
OWN = {"doc_id", "text", "path"}
ADDED = {
    "rules": set(quality_rules.ADDED),
    "licences": {"license", "cosine", "origin"},
    "pieces": {"piece_ids", "n_pieces", "decoded"},
}


def run(name, spark, docs, labels, items):
    return {
        "rules": lambda: quality_rules.rate(docs, labels),
        "licences": lambda: license_scan.scan(docs),
        "secrets": lambda: secret_scan.redact(docs),
        "spans": lambda: secret_scan.find_spans(docs),
        "copies": lambda: near_dup.keep_one(docs),
        "benchmark": lambda: decontaminate.clean(docs, items),
        "pieces": lambda: sentence_pieces.with_pieces(docs),
    }[name]()


@pytest.mark.parametrize("name", ["rules", "licences", "secrets", "spans", "copies", "benchmark", "pieces"])
def test_own_columns_stay(spark, name):
    texts = ["token = abcdef99 and more", "Released under the MIT License", "plain words " * 9, "plain words " * 9, None]
    rows = [(i, t, f"d/{i}") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, path string")
    extra = [n for n in NAMES if n not in OWN]
    docs = docs.select("*", *[F.concat(F.lit(f"{n}-"), "doc_id").alias(n) for n in extra])
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "nothing of the kind at all here")], "item_id long, text string")
    found = run(name, spark, docs, labels, items).collect()
    replaced = ADDED.get(name, set()) | ({"spans"} if name == "spans" else set())
    assert len(found) == (4 if name == "copies" else 5) and len(extra) > 60
    for r in found:
        for n in extra:
            if n.lower() not in replaced:
                assert r[n] == f"{n}-{r.doc_id}", n
