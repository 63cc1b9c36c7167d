import numpy as np
import pyarrow as pa

from tidemark.llm import quality_classifier as q


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = q.rate(spark.read.parquet(f"{sf}/documents.parquet"), labels).where("held_out").join(labels, "doc_id").collect()
    bad = [r for r in rows if r.quality == 0]
    assert len(bad) > 100
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
    assert np.mean([r.predicted == 0 for r in bad]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_score_is_the_log_density_difference():
    draw = np.random.default_rng(0)
    x = np.vstack([draw.normal(0, 1, (400, 3)), draw.normal(1, 2, (300, 3))])
    y = np.repeat([0, 1], [400, 300])
    one = np.hstack([np.ones((700, 1)), x])
    total = np.array([one[y == k].T @ one[y == k] for k in range(2)])
    model = q.from_sums(total[:, 0, 0], total[:, 0, 1:], total[:, 1:, 1:])
    pooled = sum(np.cov(x[y == k].T, bias=True) * (y == k).sum() for k in range(2)) / 700
    scale = np.sqrt(np.diag(pooled))
    z = (x - x.mean(0)) / scale
    pooled = pooled / scale[:, None] / scale[None, :]
    target = 0.9 * pooled + 0.1 * np.diag(np.diag(pooled))
    logs = []
    for k in range(2):
        own = 0.7 * np.cov(z[y == k].T, bias=True) + 0.3 * target + q.FLOOR * np.eye(3)
        away = z - z[y == k].mean(0)
        logs.append(np.log((y == k).mean()) - 0.5 * np.linalg.slogdet(own)[1] - 0.5 * np.einsum("ij,jk,ik->i", away, np.linalg.inv(own), away))
    assert np.allclose(model.score(x), 1 / (1 + np.exp(logs[0] - logs[1])))


def test_statistics_of_a_known_text():
    got = dict(zip(q.STATISTICS, q.statistics(pa.array(["Ab  ab 1# X\nAb  ab 1# X\n\n", None, ""]))[0]))
    size = len("Ab  ab 1# X\nAb  ab 1# X\n\n")
    assert np.isclose(got["log_bytes"], np.log1p(size)) and np.isclose(got["log_words"], np.log1p(8))
    assert np.isclose(got["upper"] ** 2, 4 / size) and np.isclose(got["digit"] ** 2, 2 / size)
    assert np.isclose(got["distinct_words"] ** 2, 3 / 8) and np.isclose(got["commonest_word"] ** 2, 4 / 8)
    assert np.isclose(got["ends_symbol"] ** 2, 2 / 8) and np.isclose(got["repeated_lines"] ** 2, 1 / 4)
    assert np.isfinite(q.statistics(pa.array([None, "", "a" * 100_000, " "], pa.string()))).all()


def test_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(5, 1), (5, 0), (6, 0), (8, 1), (None, 0), (7, None)], "doc_id long, quality int")
    found = q.rate(odd, labels).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)
    assert {r.score for r in q.rate(odd, labels.limit(0)).collect()} == {0.5}
    assert {r.predicted for r in q.rate(odd, labels.where("quality = 0")).collect()} <= {0, 1}
    assert q.rate(nothing, labels).count() == 0
