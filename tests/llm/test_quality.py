import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgermatch.llm import common, quality

SCHEMA = "doc_id long, text string, score string, label string"
LABELS = "doc_id long, quality int, toxic int"


def test_marginals_match_enumeration():
    rng = np.random.default_rng(0)
    count = np.array([1, 3, 2, 4])
    scores, steps = rng.normal(size=10), rng.normal(size=(2, 2))
    good, pair, total = quality.marginals(scores, steps, count)
    at = 0
    for d, n in enumerate(count):
        s = scores[at : at + n]
        weight = {y: np.exp(sum(s[i] * y[i] for i in range(n)) + sum(steps[y[i], y[i + 1]] for i in range(n - 1))) for y in itertools.product((0, 1), repeat=int(n))}
        z = sum(weight.values())
        assert np.isclose(np.log(z), total[d])
        for i in range(n):
            assert np.isclose(good[at + i], sum(w for y, w in weight.items() if y[i]) / z)
        for j, k in itertools.product((0, 1), repeat=2):
            assert np.isclose(pair[d, j, k], sum(w * sum((y[i], y[i + 1]) == (j, k) for i in range(n - 1)) for y, w in weight.items()) / z)
        at += n


def test_scans_match_the_chain_line_by_line():
    rng = np.random.default_rng(1)
    count = np.array([1, 700, 2, 3000, 64, 65, 66])
    scores, steps = rng.normal(size=count.sum()) * 3, rng.normal(size=(2, 2)) * 2
    plain = quality.marginals(scores, steps, count, long=10**9)
    for long in (1, 64, 1000):
        for a, b in zip(plain, quality.marginals(scores, steps, count, long=long)):
            assert np.allclose(a, b)
    own = np.stack([np.zeros(700), scores[1:701]], axis=1)
    for piece in (1, 2, 7, 699, 700):
        assert np.allclose(quality._long_ahead(own, steps, piece), quality._long_ahead(own, steps))


def slow_score(text, model):
    """The score of one text by one pass over its lines, from the definition of the features."""
    x, _, weight = quality.line_features([text])
    potentials = [float(row @ model.weights) for row in x]
    ahead, behind = [[0.0, potentials[0]]], [[0.0, 0.0]]
    add = lambda a, b: float(np.logaddexp(a, b))
    for s in potentials[1:]:
        a = ahead[-1]
        ahead.append([own + add(a[0] + model.steps[0, k], a[1] + model.steps[1, k]) for k, own in ((0, 0.0), (1, s))])
    for s in potentials[:0:-1]:
        b = behind[0]
        behind.insert(0, [add(model.steps[k, 0] + b[0], model.steps[k, 1] + b[1] + s) for k in (0, 1)])
    z = add(*ahead[-1])
    good = [np.exp(a[1] + b[1] - z) for a, b in zip(ahead, behind)]
    return sum(g * w for g, w in zip(good, weight)) / sum(weight)


def test_scores_of_the_query_match_the_chain_line_by_line(spark, small):
    docs, labels = common.read_table(spark, small, "documents"), common.read_table(spark, small, "labels")
    model = quality.fit_labels(docs.select("doc_id", "text"), labels.select("doc_id", "quality"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in quality.op2_quality(spark, small).collect():
        assert abs(r["score"] - slow_score(texts[r["doc_id"]], model)) < 1e-9


def test_rows_of_features_do_not_matter(monkeypatch):
    texts = [None, "a\n\nB b!\n" * 9, "one", "x\nx\n"]
    model = quality.Model(np.linspace(-1, 1, quality.WIDTH), np.array([[1.0, -1], [-0.5, 0.5]]))
    whole = quality.score_texts(texts, model)
    for rows in (1, 2, 5):
        monkeypatch.setattr(quality, "ROWS", rows)
        assert np.allclose(quality.score_texts(texts, model), whole)


def test_a_million_lines_take_seconds():
    model = quality.Model(np.linspace(-1, 1, quality.WIDTH), np.eye(2))
    assert 0 <= quality.score_texts(["a\n" * 1_000_000], model)[0] <= 1


def test_features_do_not_depend_on_pieces(monkeypatch):
    texts = [None, "", "Good line. Fine.\n\nBAD!!! BAD!!!\nx x x x x\n", "é ü ß | | |\n" * 40, "one", "a b\r\nc\td\x0be", "long " * 300 + "\nend"]
    whole = quality.line_features(texts)
    assert whole[1].tolist() == [(t or "").count("\n") + 1 for t in texts]
    for size in (1, 2, 3, 7, 50, 200):
        monkeypatch.setattr(quality, "PIECE", size)
        parts = quality.line_features(texts)
        assert np.array_equal(whole[1], parts[1]) and np.array_equal(whole[2], parts[2]) and np.array_equal(whole[0], parts[0]), size


def test_long_equal_lines_are_repeats():
    line = "ab " * 200_000
    x, _, _ = quality.line_features([f"{line}\n{line}"])
    assert x[:, 11].tolist() == [1, 1] and x[0, 10] == x[1, 10] > 0.99


def test_feature_values():
    x, count, weight = quality.line_features(["AB c1|\nAB c1|\nxy xy xy!"])
    assert count.tolist() == [3] and weight.tolist() == [7, 7, 10]
    assert np.isclose(x[0, 3], np.sqrt(2 / 6)) and np.isclose(x[0, 4], np.sqrt(1 / 6)) and np.isclose(x[0, 6], np.sqrt(1 / 6))
    assert x[:, 11].tolist() == [1, 1, 0] and np.isclose(x[2, 10], 1 / 3)
    assert x[0, quality._OWN] == 0 and x[1, quality._OWN] == 1


def test_scores_separate_held_out_documents(spark):
    d = "/root/testdata/sf0.1"
    out = quality.op2_quality(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").toPandas()
    good, bad = out[out.quality == 1], out[out.quality == 0]
    assert len(bad) > 50
    assert (good.predicted == 1).mean() > 0.95 and (bad.predicted == 0).mean() > 0.6
    order = np.argsort(np.argsort(out.score.to_numpy()))
    auc = (order[out.quality.to_numpy() == 1].sum() - len(good) * (len(good) - 1) / 2) / (len(good) * len(bad))
    assert auc > 0.9


def test_held_out_labels_are_not_used(spark, small):
    docs, labels = common.read_table(spark, small, "documents"), common.read_table(spark, small, "labels")
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit_labels(docs, labels), quality.fit_labels(docs, flipped)
    assert np.array_equal(a.weights, b.weights)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, None, None), (None, 0, 0)]])
def test_without_labels_of_both_kinds(spark, labels):
    docs = spark.createDataFrame([(1, "a", "c", "c"), (None, None, None, None), (1, "", None, None), (1, "a", "c", "c")], SCHEMA)
    out = docs.select(quality.scores(F.col("text"), quality.fit_labels(docs, spark.createDataFrame(labels, LABELS))).alias("s")).collect()
    assert [r["s"] for r in out] == [0.5] * 4
    assert quality.keep_good(docs, spark.createDataFrame(labels, LABELS)).columns == docs.columns


def test_the_sample_is_bounded_in_lines(spark, monkeypatch):
    monkeypatch.setattr(quality, "TRAIN_LINES", 500)
    seen = {}
    monkeypatch.setattr(quality, "fit", lambda x, count, label: seen.update(n=int(count.sum()), docs=len(count)) or quality.Model(np.zeros(quality.WIDTH), np.zeros((2, 2))))
    docs = spark.createDataFrame([(i, "line\n" * 40, None, None) for i in range(60)], SCHEMA)
    quality.fit_labels(docs, spark.createDataFrame([(i, i % 2, 0) for i in range(60)], LABELS))
    assert 400 < seen["n"] <= 500 and seen["docs"] == 12


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert quality.keep_good(docs, spark.createDataFrame([], LABELS)).count() == 0


def test_very_long_text():
    model = quality.Model(np.ones(quality.WIDTH), np.eye(2))
    assert 0 <= quality.score_texts(["word " * 1_000_000, "line\n" * 20_000], model).min() <= 1
