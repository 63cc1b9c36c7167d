import hashlib
import random
from collections import Counter

import numpy as np

from tidemark.llm import suffix_dedup as s


def brute(rows, size=200):
    raws = [(r.text or "").encode() for r in rows]
    seen = Counter(raw[i : i + size] for raw in raws for i in range(len(raw) - size + 1))
    out = []
    for r, raw in zip(rows, raws):
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - size + 1):
            if seen[raw[i : i + size]] > 1:
                gone[i : i + size] = True
        gone[-1] = False
        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(raw) else 0
        left = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((str(r.doc_id), len(raw), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def test_same_as_brute_force(documents):
    assert result(s.repeated(documents)) == brute(documents.collect())


def test_odd_rows(odd, nothing):
    assert result(s.repeated(odd)) == brute(odd.collect())
    assert s.repeated(nothing).count() == 0


def test_planted_passages(spark, monkeypatch):
    draw = random.Random(1)
    text = lambda k: "".join(draw.choice("abcdefgh \né") for _ in range(k))
    passage, edge, short = text(300), text(150), text(150)
    exact = passage.encode()[:200].decode("utf-8", "ignore")
    rows = [(k, text(draw.randrange(400)) + passage + text(draw.randrange(400))) for k in range(12)]
    rows += [(20 + k, text(90) + exact + text(90)) for k in range(3)]
    rows += [(30 + k, text(300) + edge + short[: 30 + 5 * k] + text(300)) for k in range(24)]  # matches of 180 to 295
    rows += [(60, text(50) + text(250) * 3 + text(50)), (61, "ab" * 500 + text(100)), (62, ("x" * 199)), (63, "x" * 201), (64, "y" * 200), (65, "y" * 200)]
    rows += [(66, passage), (67, passage + passage), (68, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(df.collect())
    assert result(s.repeated(df)) == want
    monkeypatch.setattr(s, "PIECE", 128)  # in this process only: the parts below run here
    for raw in (r[1].encode() for r in rows if r[1]):
        data, at = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
        starts = np.concatenate([begin + st + np.arange(n) for piece, o, _, begin in s._pieces(data, at) for st, n in zip(*s._runs(piece, o)[1:3])] or [np.zeros(0)])
        assert sorted(starts.tolist()) == list(range(len(raw) - 199))


def test_line_twice_in_one_text_only(spark):
    draw = random.Random(2)
    text = lambda k: "".join(draw.choice("abcdefgh \n") for _ in range(k))
    rows = []
    for k in range(40):
        line, before = text(draw.randrange(32, 170)), text(draw.randrange(170, 260))
        rows += [(4 * k, text(60) + before + line * 2 + text(60)), (4 * k + 1, text(60) + before + line + text(60))]
        rows += [(4 * k + 2, text(60) + line * 3 + before + text(60)), (4 * k + 3, text(60) + line + before + text(60))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(df.collect())
    assert sum(w[2] > 0 for w in want) == len(rows)
    assert result(s.repeated(df)) == want


def test_spans_cut_the_text(documents):
    rows = {r.doc_id: r for r in s.repeated(documents).collect()}
    for d in documents.collect():
        raw, r = d.text.encode(), rows[d.doc_id]
        left, at = b"", 0
        for a, b in zip(r.begins, r.stops):
            left, at = left + raw[at:a], b
        assert hashlib.sha256(left + raw[at:]).hexdigest() == r.kept_sha256


def test_merged():
    start, stop = s.merged(np.array([5, 0, 9, 30]), np.array([5, 3, 4, 1]))
    assert (start.tolist(), stop.tolist()) == ([0, 5, 30], [3, 13, 31])
