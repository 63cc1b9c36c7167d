import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    repeats = len(lines) - len(set(lines))
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, repeats, len(covered)


def grams(text):
    words = WORD.findall(text or "")
    codes = [zlib.crc32(w[-2:].encode()) for w in words]
    return [(a * q.PAIR_STEP + b) % q.BUCKETS for a, b in zip([0, *codes], codes)] + [zlib.crc32(w.encode()) * q.WORD_STEP % q.BUCKETS for w in words]


def check(docs, labels, rated):
    good = {r.doc_id for r in labels if r.quality == 1 and r.doc_id is not None}
    fold = lambda r: int(hashlib.md5((r.text or "").encode()).hexdigest()[0], 16) % 4
    raw, trusted = ([Counter() for _ in range(4)] for _ in range(2))  # by fold that is left out
    for r in docs:
        for f in range(4):
            if f != fold(r):
                raw[f].update(grams(r.text))
                trusted[f].update(grams(r.text) if r.doc_id in good else [])
    share = [sum(trusted[f].values()) / max(sum(raw[f].values()), 1) for f in range(4)]

    def ratios(r, found):
        f = fold(r)
        return [round(1e6 * math.log((trusted[f][b] + 1) / (share[f] * raw[f][b] + 1))) for b in found]

    want = []
    for r in docs:
        w, chars, symbols, lines, repeated = base(r.text)
        found = ratios(r, grams(r.text))
        score = sum(found) / len(found) / 1e6 if found else 0.0
        failed = w < 10 or 100 * repeated > 20 * w
        want.append((r.doc_id, w, chars, symbols, lines, repeated, failed, not failed and sum(found) >= round(-0.6e6) * len(found), round(score, 7)))
    got = [
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept, round(r.score, 7)) for r in rated
    ]
    order = lambda x: tuple(str(v) for v in x)
    assert sorted(got, key=order) == sorted(want, key=order)


def test_same_as_brute_force(spark, sf, documents):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    check(documents.collect(), labels.collect(), q.rate(documents, labels).collect())


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 0), (None, 1, 0), (6, None, None)], "doc_id long, quality int, toxic int")
    rated = q.rate(odd, labels)
    check(odd.collect(), labels.collect(), rated.collect())
    assert {"lang", "_row", "words"} <= set(rated.columns)


def test_without_labels_or_rows(spark, odd, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    check(odd.collect(), [], q.rate(odd, none).collect())
    assert q.rate(nothing, none).count() == 0


def test_labels_agree_with_verdicts(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = q.rate(spark.read.parquet(f"{sf}/documents.parquet"), labels).where("not base_failed").join(labels, "doc_id").collect()
    assert sum(r.kept == (r.quality == 1) for r in rows) >= 0.97 * len(rows)


@pytest.mark.parametrize("share", [60, 30, 15])
def test_withheld_labels_agree_with_verdicts(spark, share):
    """Verdicts on texts whose labels are withheld do not depend on how many others are labelled."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    shown = F.pmod(F.hash("doc_id"), F.lit(100)) < share
    rated = q.rate(spark.read.parquet(f"{sf}/documents.parquet"), labels.where(shown)).where("not base_failed")
    rows = rated.join(labels.where(~shown), "doc_id").collect()
    assert len(rows) > 100 and sum(r.quality == 0 for r in rows) > 5
    assert sum(r.kept == (r.quality == 1) for r in rows) >= 0.97 * len(rows)
