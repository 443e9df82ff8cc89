"""Operator 13."""

import math

import numpy as np
import pytest

from larkspur import llm
from larkspur.llm import nbsvm

FOLDER = "/root/testdata/sf0.01"


def test_held_out_quality(spark):
    got = llm.QUERIES["op13_quality_classifier"](spark, FOLDER)
    truth = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality")
    rows = got.join(truth, "doc_id").where("held_out").collect()
    one = np.array([r.score for r in rows if r.quality == 1])
    zero = np.array([r.score for r in rows if r.quality == 0])
    assert len(zero) >= 5 and (one[:, None] > zero[None, :]).mean() >= 0.97
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS string)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    known = docs.where(~nbsvm.held_out("doc_id"))
    a, b = (nbsvm.labelled_rows(known, x).select("h", "y") for x in (labels, turned))
    assert sorted(a.collect()) == sorted(b.collect())


def test_descent_reaches_the_optimum():
    rng = np.random.default_rng(3)
    rows, y = [], []
    for i in range(60):
        ids = np.sort(rng.choice(40, 12, replace=False))
        rows.append((ids, rng.normal(size=12)))
        y.append(1.0 if rows[-1][1][:5].sum() + 0.8 * rng.normal() > 0 else -1.0)
    y, cost = np.array(y), np.where(np.arange(60) % 2, 0.5, 1.5)
    w, alpha = nbsvm.dual_coordinate_descent(rows, y, cost, 40, 2000)
    assert (alpha >= 0).all() and (alpha <= cost).all()
    built = np.zeros(41)
    for (ids, x), label, a in zip(rows, y, alpha):
        built[ids] += a * label * x
        built[-1] += a * label
    assert built == pytest.approx(w)
    margins = np.array([label * (w[ids] @ x + w[-1]) for (ids, x), label in zip(rows, y)])
    primal = w @ w / 2 + (cost * np.maximum(0, 1 - margins)).sum()
    dual = alpha.sum() - w @ w / 2
    assert primal - dual < 1e-2 * primal  # no weights do better than the dual bound


def test_ratios_are_counts_over_all_rows(spark):
    texts = [("good plain words here", 1), ("good other words", 1), ("BAD!! BAD!!", 0), ("bad bad bad", 0), ("good plain words here", 1)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)] + [(9, None), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)] + [(9, 0), (None, 1), (3, None)], "doc_id long, quality int")
    rows = nbsvm.labelled_rows(docs, labels)
    assert rows.count() == 5  # equal texts once, the null text, not the null key
    s = nbsvm.Settings()
    held = {y: [set(nbsvm.grams(t, s.buckets).tolist()) for t in {t for t, k in texts + [("", 0)] if k == y}] for y in (0, 1)}
    total = {y: sum(map(len, held[y])) + s.smoothing * s.buckets for y in held}
    ratio = nbsvm.log_count_ratio(rows, s)
    for b in set().union(*held[0], *held[1], {12345}):
        one, zero = (sum(b in g for g in held[y]) + s.smoothing for y in (1, 0))
        assert ratio[b] == pytest.approx(math.log(one / total[1]) - math.log(zero / total[0]), abs=1e-5)


def test_pieces_of_a_long_text_add_up():
    text = "One two TWO two, 12 of ### all\nStraßen 東京. " * 40 + "z" * 500
    for piece in (40, 333):
        cut = "One two TWO two, 12 of ### all\nStraßen 東京. " * 40
        assert np.array_equal(nbsvm.grams(cut, 1 << 18), nbsvm.grams(cut, 1 << 18, piece))
    assert len(nbsvm.grams(text, 1 << 18))


def test_quality_of_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, 0), (2, 0), (8, 1), (None, 1)], "doc_id long, quality int")
    rows = nbsvm.labelled_rows(odd_docs, labels)
    model = nbsvm.train(nbsvm.sample(rows), nbsvm.log_count_ratio(rows))
    got = nbsvm.score(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    blank = {r.score for r in got if r.doc_id in (1, 2, 3, 7)}
    assert len(blank) == 1
    nothing = nbsvm.labelled_rows(odd_docs.limit(0), labels)
    empty = nbsvm.train(nbsvm.sample(nothing), nbsvm.log_count_ratio(nothing))
    assert {r.score for r in nbsvm.score(odd_docs, empty).collect()} == {0.5}
    assert nbsvm.score(odd_docs.limit(0), empty).count() == 0
