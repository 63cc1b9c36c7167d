import math
import re
import zlib
from collections import Counter

import numpy as np

from tidemark.llm import lm_score as m
from tidemark.llm.sentence_pieces import MODEL, vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def pieces(word):
    """All edges (start, end, piece) of a word over its characters; unknown characters are one edge of their bytes."""
    v = vocabulary(MODEL)
    known = pieces.known = getattr(pieces, "known", None) or {v.pieces[i]: i for i in range(len(v.pieces)) if i in set(v.searched.tolist()) or v.single[ord(v.pieces[i][0])] == i and len(v.pieces[i]) == 1}
    out = []
    for a in range(len(word)):
        if word[a] not in known:
            out.append((a, a + 1, v.bytes[list(word[a].encode())].tolist()))
        for b in range(a + 1, min(len(word), a + 17) + 1):
            if word[a:b] in known:
                out.append((a, b, [known[word[a:b]]]))
    return out


def marginal(word, score, skip=None):
    ways = [0.0] * (len(word) + 1)
    ways[0] = 1.0
    for a, b, ids in sorted(pieces(word)):
        ways[b] += ways[a] * math.exp(sum(score[i] for i in ids))
    return math.log(ways[-1])


def brute_base(rows):
    train = Counter()
    for r in rows:
        if not held(r.doc_id):
            train.update(words(r.text) + [None])
    n, v = sum(train.values()), len(train)
    out = []
    for r in rows:
        tokens = words(r.text) + [None]
        score = sum(math.log10((train[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        out.append((str(r.doc_id), held(r.doc_id), len(tokens), sum(train[t] > 0 for t in tokens), n, round(score, 5)))
    return sorted(out)


def result(found):
    return sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in found)


def test_base_score_same_as_brute_force(documents):
    found = m.scores(documents).collect()
    assert result(found) == brute_base(documents.collect())
    assert all(r.score < 0 for r in found)


def test_odd_rows(spark, odd, nothing):
    found = m.scores(odd).collect()
    assert result(found) == brute_base(odd.collect())
    assert m.scores(nothing).count() == 0
    unseen = spark.createDataFrame([(k, "some words") for k in range(60) if held(k)], "doc_id long, text string")
    assert {r.train_tokens for r in m.scores(unseen).collect()} == {0}


def test_marginal_sums_all_segmentations():
    v = vocabulary(MODEL)
    score = m.first_scores(v)
    texts = ["the", "reading", "日x", "é", "aaaaaaa", "thtionnt", "x😀y", "internationalisation" * 3]
    got = m.Lattice(v, texts).marginals(score)
    assert np.allclose(got, [marginal("▁" + t, score) for t in texts])
    # Expected uses are the derivative of the log marginal with respect to each piece's score.
    uses = m.Lattice(v, texts).expected(score, np.ones(len(texts)))
    for piece in np.argsort(-uses)[:5].tolist():
        up, down = score.copy(), score.copy()
        up[piece] += 1e-4
        down[piece] -= 1e-4
        slope = (m.Lattice(v, texts).marginals(up).sum() - m.Lattice(v, texts).marginals(down).sum()) / 2e-4
        assert abs(slope - uses[piece]) < 1e-3


def test_text_score_is_the_product_of_its_words(spark, documents):
    """Scores follow from the counts: learn the pieces by hand and compare."""
    rows = documents.limit(12).collect()
    v = vocabulary(MODEL)
    train = Counter(w for r in rows if not held(r.doc_id) for w in words(r.text))
    uses = m.Lattice(v, list(train)).expected(m.first_scores(v), np.array(list(train.values()), float))
    counts = np.append(uses, sum(not held(r.doc_id) for r in rows)) + m.PIECE_PRIOR
    learnt = np.log(counts / counts.sum())
    found = {r.doc_id: r.score for r in m.scores(spark.createDataFrame(rows)).collect()}
    for r in rows:
        want = (sum(marginal("▁" + w, learnt) for w in words(r.text)) + learnt[-1]) / math.log(10)
        assert abs(found[r.doc_id] - want) < 1e-6 * abs(want)


def test_shared_hash_is_counted_apart(monkeypatch):
    import pyarrow as pa

    def rows(found):
        word, train, stops, owner, n = found
        begins = [0, *stops.tolist()]
        return sorted((w, t, tuple(zip(owner[a:b].tolist(), n[a:b].tolist()))) for w, t, a, b in zip(word.to_pylist(), train.tolist(), begins, stops.tolist()))

    texts, held = pa.array(["b a b", None, "c a"]), np.array([False, False, True])
    want = rows(m._count_words(texts, held))
    monkeypatch.setattr(m, "hash_spans", lambda data, start, end: np.zeros(len(start), np.uint64))
    assert rows(m._count_words(texts, held)) == want == [("a", 1, ((0, 1), (2, 1))), ("b", 2, ((0, 2),)), ("c", 0, ((2, 1),))]
