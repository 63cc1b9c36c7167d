import hashlib
import random
import re
import zlib
from fractions import Fraction

from tidemark.llm import periodic_runs as m

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, least=6, copies=4):
    n, out = len(words), []
    for q in range(1, n // copies + 1):
        at = 0
        while at < n - q:
            stop = at
            while stop < n - q and words[stop] == words[stop + q]:
                stop += 1
            length = stop - at + q
            if stop > at and length >= max(least, copies * q):
                part = words[at : at + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((at, length, q))
            at = stop + 1
    return sorted((s, length, q) for s, length, q in out)


def words_of(doc_id, text, change):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if change and doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def brute(rows, change=True):
    out = []
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in rows:
        words = words_of(r.doc_id, r.text, change)
        found = brute_runs(words)
        best = max(found, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=(None,) * 3)
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        out.append((
            r.doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
        ))
    return sorted(map(str, out))


def result(found):
    return sorted(str(tuple(r)) for r in found.collect())


def made(draw):
    letters = draw.choice((1, 2, 3, 40))
    words = []
    for _ in range(draw.randrange(8)):
        unit = [str(draw.randrange(letters)) for _ in range(draw.randrange(1, 9))]
        words += (unit * draw.randrange(1, 9))[: draw.randrange(1, 60)]
    return words


def test_same_as_brute_force(spark, documents):
    short = documents.where("n_chars < 6000")
    assert short.count() > 150
    assert result(m.summarise(short, m.made_periodic)) == brute(short.collect())


def test_random_texts(spark):
    draw = random.Random(11)
    rows = [(i, " ".join(made(draw))) for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(m.summarise(df)) == brute(df.collect(), change=False)
    assert result(m.summarise(df, m.made_periodic)) == brute(df.collect())


def test_odd_rows(odd, nothing):
    assert result(m.summarise(odd, m.made_periodic)) == brute(odd.collect())
    assert result(m.summarise(odd)) == brute(odd.collect(), change=False)
    assert m.summarise(nothing, m.made_periodic).count() == 0
    found = {r.doc_id: r for r in m.find_runs(odd.where("doc_id in (8, 10)")).collect()}
    assert [tuple(r) for r in found[10].runs] == [(0, 80, 2)] and found[10].collapsed == "a b"


def test_long_texts(spark, monkeypatch):
    """Texts beyond the size of a slice: one word over and over, a long period, and no repetition at all."""
    monkeypatch.setattr("tidemark.llm.arrays.CHUNK_BYTES", 1000)
    draw = random.Random(3)
    unit = " ".join(str(draw.randrange(10**6)) for _ in range(5000))
    rows = [(1, "a " * 30_000), (2, " ".join([unit] * 5)), (3, unit), (4, "b c " * 9)]
    found = {r.doc_id: r for r in m.find_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(r) for r in found[1].runs] == [(0, 30_000, 1)] and found[1].collapsed == "a"
    assert [tuple(r) for r in found[2].runs] == [(0, 25_000, 5000)] and found[2].collapsed == unit
    assert not found[3].runs and found[3].collapsed == unit
    assert found[4].collapsed == "b c"


def test_other_limits():
    import numpy as np

    draw = random.Random(6)
    texts = [made(draw) for _ in range(200)]
    codes = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
    words = np.array([codes[w] for t in texts for w in t])
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    for least, copies in ((2, 4), (10, 3), (4, 5)):
        assert m.batch_runs(words, owner, len(texts), least, copies) == [brute_runs(t, least, copies) for t in texts]
