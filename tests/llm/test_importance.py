import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import importance as m

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text):
    words = WORD.findall(re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))
    return words, [zlib.crc32(f.encode()) % 10_000 for f in [*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))]]


def brute(docs, target):
    raw, wanted = Counter(), Counter()
    for texts, counts in ((docs, raw), (target, wanted)):
        for r in texts:
            counts.update(grams(r.text)[1])
    s, t = sum(raw.values()) + 10_000, sum(wanted.values()) + 10_000
    gain = {b: math.floor(1000 * math.log(((wanted[b] + 1) * s) / ((raw[b] + 1) * t))) for b in raw}
    rows = []
    for r in docs:
        words, found = grams(r.text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([r.doc_id, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0]))
    for place, r in enumerate(able[: 25 * len(able) // 100]):
        r[5] = place + 1
    return sorted(map(str, map(tuple, rows)))


def result(found):
    return sorted(str(tuple(r)) for r in found.collect())


@pytest.fixture(scope="module")
def benchmark(spark, sf):
    return spark.read.parquet(f"{sf}/benchmark.parquet")


def test_same_as_brute_force(documents, benchmark):
    assert result(m.resample(documents, benchmark)) == brute(documents.collect(), benchmark.collect())


def test_odd_rows(spark, odd, nothing, benchmark):
    many = odd.union(odd).union(odd)  # ties in score and id
    assert result(m.resample(many, benchmark)) == brute(many.collect(), benchmark.collect())
    assert result(m.resample(odd, benchmark.limit(0))) == brute(odd.collect(), [])
    assert m.resample(nothing, benchmark).count() == 0
    drawn = m.draw(many, benchmark)
    assert drawn.columns == many.columns
    assert drawn.count() == m.resample(many, benchmark).where("rank is not null").count()
    assert {r._row for r in drawn.collect()} == {"row"}


def test_ranks_do_not_depend_on_cells(documents, benchmark, monkeypatch):
    whole = result(m.resample(documents, benchmark))
    ranked = m.group_rank
    monkeypatch.setattr(m, "group_rank", lambda df, keys, order, name: ranked(df, keys, order, name, max_rows=1))
    assert result(m.resample(documents, benchmark)) == whole


def test_planes_sum_exactly():
    draw = np.random.default_rng(2)
    gains = draw.integers(-12_345, 12_345, 700)
    text, bucket = np.repeat(np.arange(5), 3000), draw.integers(0, 700, 15_000)
    bucket[:3000] = 7  # a count of many bits
    want = np.bincount(text, weights=gains[bucket], minlength=6).astype(int)
    assert m.GainPlanes(gains.tolist()).sums(text, bucket, 6).tolist() == want.tolist()


def test_crc_of_joined_words():
    words = [b"a", "日本".encode(), b"x" * 70_000, b"10"]
    crc, size = np.array([zlib.crc32(w) for w in words], np.uint32), np.array([len(w) for w in words])
    for w in words:
        left = np.full(len(words), zlib.crc32(w), np.uint32)
        assert m.joined_crc(left, crc, size).tolist() == [zlib.crc32(w + v) for v in words]
    assert m.features(pa.array([None, ""], pa.string()))[2].tolist() == [0, 0]
