from __future__ import annotations

import zlib

import numpy as np
import pytest

from ordermill.llm import quality
from ordermill.llm.boosting import fit
from ordermill.llm.registry import op10_quality


def test_flat_traversal_equals_a_walk_from_node_to_node():
    rng = np.random.default_rng(0)
    values = rng.normal(size=(600, 5))
    labels = ((values[:, 0] > 0.3) ^ (values[:, 2] > 0)).astype(float)
    model = fit(values, labels, trees=30, depth=3)
    chance = model.probability(values)
    for row in range(50):
        total = model.base
        for tree in range(30):
            node = 0
            while node < model.feature.shape[1]:
                node = 2 * node + 1 + bool(values[row, model.feature[tree, node]] > model.threshold[tree, node])
            total += model.leaf[tree, node - model.feature.shape[1]]
        assert np.isclose(chance[row], 1 / (1 + np.exp(-total)))
    assert ((chance >= 0.5) == (labels == 1)).mean() > 0.95


def test_first_split_is_the_best_of_all():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 20, (300, 3)).astype(float)
    labels = (values[:, 1] + rng.normal(size=300) > 9).astype(float)
    model = fit(values, labels, trees=1, depth=1)
    chance = labels.mean() * 300 + 1
    chance = chance / 302
    slope, curve = chance - labels, np.full(300, chance * (1 - chance))

    def gain(column, cut):
        left = values[:, column] <= cut
        parts = [(slope[k].sum(), curve[k].sum()) for k in (left, ~left)]
        return sum(g * g / (h + 1) for g, h in parts) if min(h for _, h in parts) >= 1 else 0

    best = max(((gain(column, cut), column, cut) for column in range(3) for cut in range(19)))
    assert np.isclose(gain(int(model.feature[0, 0]), model.threshold[0, 0]), best[0])


def test_one_label_or_none():
    assert fit(np.zeros((0, 3)), np.zeros(0)).probability(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert (fit(np.zeros((5, 3)), np.ones(5)).probability(np.zeros((1, 3))) > 0.8).all()


def test_held_out_accuracy_of_the_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in op10_quality(spark, folder).collect()}
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows.values())
    labels = [r for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if rows[r.doc_id].held_out]
    assert np.mean([rows[r.doc_id].predicted == r.quality for r in labels]) > 0.95
    assert np.mean([not rows[r.doc_id].predicted for r in labels if r.quality == 0]) > 0.8


def test_held_out_labels_change_nothing(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    turned = labels.withColumn("quality", quality.F.when(quality.held_out(), 1 - labels.quality).otherwise(labels.quality))
    a, b = quality.train(docs, labels), quality.train(docs, turned)
    assert (a.leaf == b.leaf).all() and (a.feature == b.feature).all()
    assert len(quality.train(docs, labels, sample=10).leaf) >= 0


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(None, None, 1.0), (1, "", 1.0), (1, "a b", 1.0), (2, "x" * 300_000, 1.0), (3, "!!! ???", 1.0), (3, "!!! ???", 1.0)],
        "doc_id bigint, text string, `_id` double",
    )
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 0), (9, 1)], "doc_id bigint, quality int")
    got = quality.scored(docs, quality.train(docs, labels))
    assert got.columns == [*docs.columns, "score"]
    assert all(0 <= r.score <= 1 for r in got.collect()) and got.count() == 6
    model = quality.train(docs.limit(0), labels)
    assert {r.score for r in quality.scored(docs, model).collect()} == {0.5}
    assert quality.scored(docs.limit(0), model).count() == 0


def test_a_second_score_is_refused(spark):
    docs = spark.createDataFrame([(1, "a", 3)], "doc_id bigint, text string, score int")
    model = quality.train(docs, spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    with pytest.raises(ValueError, match="score"):
        quality.scored(docs, model)
    assert quality.scored(docs, model, score="other").first().score == 3
