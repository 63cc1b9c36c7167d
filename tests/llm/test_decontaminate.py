import re
from collections import defaultdict

from tidemark.llm import decontaminate as d

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall((text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(docs, items):
    best = defaultdict(int)
    for r in docs:
        own = shingles(r.text)
        for item in {(i.item_id, i.text) for i in items}:
            need = shingles(item[1])
            if need and len(need & own) >= 0.8 * len(need):
                key = (r.doc_id, item[0], len(need))
                best[key] = max(best[key], len(need & own))
    return {(*k, v) for k, v in best.items()}


def rows(found):
    return {(r.doc_id, r.item_id, r.n_item, r.n_shared) for r in found.collect()}


def test_same_as_brute_force(spark, documents):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    want = brute(big.collect(), items.collect())
    assert len(want) > 10 and rows(d.contaminated(big, items)) == want
    dirty = {w[0] for w in want}
    assert {r.doc_id for r in d.clean(big, items).collect()} == {r.doc_id for r in big.collect()} - dirty


def test_shares_at_the_edge(spark):
    words = [f"w{i}" for i in range(104)]  # 100 shingles; each changed word costs five
    item = [(1, " ".join(words)), (2, "too short here"), (3, None), (4, " ".join(words[:9]))]
    items = spark.createDataFrame(item, "item_id long, text string")
    docs = []
    for k in range(7):
        changed = list(words)
        for j in range(k):
            changed[10 + 12 * j] = f"x{j}"
        docs.append((k, "before " * 50 + " ".join(changed).upper() + " after" * 50))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    found = d.contaminated(docs, items).where("item_id = 1").collect()
    assert {r.doc_id: r.n_shared for r in found} == {0: 100, 1: 95, 2: 90, 3: 85, 4: 80}
    assert rows(d.contaminated(docs, items)) == brute(docs.collect(), [spark_row for spark_row in items.collect()])


def test_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta"), (1, "alpha beta gamma delta epsilon zeta"), (None, "pi rho sigma tau upsilon")], "item_id long, text string")
    found = d.contaminated(odd, items)
    assert rows(found) == brute(odd.collect(), items.collect())
    assert found.count() == len(rows(found))
    assert d.contaminated(nothing, items).count() == 0
    assert d.contaminated(odd, items.limit(0)).count() == 0
    assert d.clean(odd, items.limit(0)).count() == odd.count()


def test_shuffled_paths_agree(spark, odd, monkeypatch):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta")], "item_id long, text string")
    want = rows(d.contaminated(odd, items))
    monkeypatch.setattr(d, "is_small", lambda df: False)
    assert rows(d.contaminated(odd, items)) == want and want
