import random
import re
from collections import Counter

import numpy as np

from tidemark.llm import near_dup as n

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def bag(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    """Class id by row number."""
    bags = [bag(r.text) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = (rows[i].text or "") == (rows[j].text or "")
            if not same and bags[i] and bags[j]:
                if len(bags[i]) + len(bags[j]) and 0.5 < (sum(bags[i].values()) / sum(bags[j].values())) < 2:
                    shared = sum((bags[i] & bags[j]).values())
                    same = shared >= 0.8 * (sum(bags[i].values()) + sum(bags[j].values()) - shared)
            if same:
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i].doc_id)
    return sorted((str(rows[i].doc_id), str(min((x for x in groups[find(i)] if x is not None), default=None)), len(groups[find(i)])) for i in range(len(rows)))


def result(found):
    return sorted((str(r.doc_id), str(r.class_id), r.class_rows) for r in found.collect())


def test_same_as_brute_force(documents):
    assert result(n.classes(documents)) == brute(documents.collect())


def test_odd_rows(odd, nothing):
    found = n.classes(odd)
    assert result(found) == brute(odd.collect())
    assert found.where("kept").count() == found.select("class_id", "class_rows", "digest").where("true").join(found.where("kept").select("digest"), "digest").select("digest").distinct().count()
    assert n.classes(nothing).count() == 0
    kept = n.keep_one(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({(c, k) for _, c, k in brute(odd.collect())})
    assert n.keep_one(nothing).count() == 0


def test_groups_of_near_copies(spark):
    """Chains, hubs and a bucket of several groups: every link counts, however it is found."""
    draw = random.Random(5)
    rows, key = [], 0
    for g in range(6):
        words = [f"g{g}w{draw.randrange(10**6)}" for _ in range(120)]
        for _ in range(25):
            copy = list(words)
            for _ in range(draw.randrange(4)):
                copy[draw.randrange(len(copy))] = f"n{draw.randrange(10**6)}"
            rows.append((key, " ".join(copy)))
            key += 1
            if draw.random() < 0.2:
                words = copy  # the group drifts away from its first member
    passage = " ".join(f"common{i}" for i in range(60))
    rows += [(key + i, passage + " " + " ".join(f"own{i}x{j}" for j in range(60))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(n.classes(df)) == brute(df.collect())


def test_divided_buckets_in_blocks(spark, monkeypatch):
    """Buckets that stay divided are compared in blocks smaller than they are, among texts of very unequal length."""
    monkeypatch.setattr(n, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(n, "ROWS", 2)  # bands that many unlike texts share
    monkeypatch.setattr(n, "BANDS", n.SLOTS // 2)
    draw = random.Random(12)
    shared = [f"s{draw.randrange(10**6)}" for _ in range(70)]
    rows = []
    for k in range(90):
        own = [f"o{draw.randrange(10**6)}" for _ in range(draw.choice((8, 12, 16, 30)))]
        words = list(shared)
        for _ in range(draw.randrange(3)):
            words[draw.randrange(len(words))] = f"c{draw.randrange(10**6)}"
        rows.append((k, " ".join(words + own)))
    rows.append((90, " ".join(f"w{i % 5000}" for i in range(20_000)) + " " + rows[0][1]))
    rows += [(91 + k, rows[k][1] + " tail") for k in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(n.classes(df)) == brute(df.collect())


def test_links_inside_are_those_of_all_pairs():
    import pyarrow as pa

    draw = random.Random(2)
    sets = []
    for _ in range(60):
        base = sets[draw.randrange(len(sets))] if sets and draw.random() < 0.7 else {draw.randrange(10**6) for _ in range(30)}
        sets.append({x if draw.random() > 0.05 else draw.randrange(10**6) for x in base})
    roots = [draw.randrange(60) for _ in sets]
    alike = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    for blocks in (1, 2):
        mine = [i % blocks for i in range(60)]
        rows = pa.table({"x": [0] * 60, "y": [blocks - 1] * 60, "mine": mine, "root": roots, "windows": pa.array([sorted(s) for s in sets], pa.list_(pa.int64()))})
        got = n._links_inside(rows).to_pylist()

        def joined(links):
            up = list(range(60))

            def find(i):
                while up[i] != i:
                    i = up[i]
                return i

            for a, b in links:
                up[find(a)] = find(b)
            return [[find(a) == find(b) for a in set(roots)] for b in set(roots)]

        pairs = [(roots[i], roots[j]) for i in range(60) for j in range(i) if alike(sets[i], sets[j]) and (blocks == 1 or mine[i] != mine[j])]
        assert joined([(g["a"], g["b"]) for g in got]) == joined(pairs)
        assert len(got) < len(set(roots))  # one link for two classes


def test_signature_is_weighted_jaccard():
    draw = np.random.default_rng(3)
    values = draw.integers(1, 2**62, 60).astype(np.uint64)
    a, b = draw.integers(0, 9, 60), draw.integers(0, 9, 60)
    text = np.repeat([0, 1], 60)
    weight, value = np.concatenate([a, b]), np.concatenate([values, values])
    kept = weight > 0
    slots = 4000
    sig = n.signatures(text[kept], value[kept], weight[kept], 2, slots)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert np.isfinite(sig).all()
    assert abs((sig[0] == sig[1]).mean() - want) < 4 * (want * (1 - want) / slots) ** 0.5


def test_shuffled_paths_agree(odd, monkeypatch):
    import tidemark.llm.texts as t

    monkeypatch.setattr(t, "is_small", lambda df: False)
    monkeypatch.setattr(n, "is_small", lambda df: False)
    assert result(n.classes(odd)) == brute(odd.collect())
