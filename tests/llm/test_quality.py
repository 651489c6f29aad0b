import os
import zlib

import numpy as np

from tests.llm.common import frame, rows, with_clashes, words
from tidegrid.llm import quality


def corpus(spark, n=400):
    junk = lambda k: " ".join(f"{x.upper()}!!" for x in words(40, k).split()) if k % 2 else " ".join([words(6, k)] * 8)
    data = [(k, junk(k) if k % 5 < 2 else words(50, k), None, None, None) for k in range(n)]
    labels = spark.createDataFrame([(k, int(k % 5 >= 2)) for k in range(n)] + [(None, 1), (3, None)], "doc_id bigint, quality int")
    return frame(spark, data), labels


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    out = quality.quality_digest(docs, labels).collect()
    held = [r for r in out if r.held_out]
    assert {r.doc_id for r in held} == {k for k in range(400) if zlib.crc32(str(k).encode()) % 4 == 2}
    assert np.mean([r.predicted == int(r.doc_id % 5 >= 2) for r in held]) > 0.95
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in out)


def test_scores_do_not_depend_on_batches(spark):
    docs, labels = corpus(spark)
    model = quality.fitted_on(docs, labels)
    mixed = docs.union(frame(spark))
    a = {(r.doc_id, r.text): r.score for r in quality.score(mixed, model).collect()}
    b = {(r.doc_id, r.text): r.score for r in quality.score(mixed.repartition(5), model).collect()}
    assert a == b and a[3, None] if (3, None) in a else True
    kept = quality.score(with_clashes(mixed), model, keep_at=0.7)
    assert kept.columns == with_clashes(mixed).columns and kept.count() == sum(1 for r in quality.score(mixed, model).collect() if r.score >= 0.7)


def test_no_labels(spark):
    docs, labels = corpus(spark, 20)
    out = quality.quality_digest(frame(spark), labels.limit(0)).collect()
    assert {r.score for r in out} == {0.5} and len(out) == len(rows())
    ones = quality.quality_digest(docs, labels.where("quality = 1")).collect()
    assert all(r.score > 0.9 for r in ones)
    assert quality.quality_digest(frame(spark, []), labels).collect() == []


def test_training_is_not_in_the_driver(spark, monkeypatch):
    docs, labels = corpus(spark, 40)
    monkeypatch.setattr(quality, "train", lambda rows, seed=5: quality.Model(np.full(quality.FEATURES, len(rows)), float(os.getpid())))
    model = quality.fitted_on(docs, labels)
    assert model.bias != os.getpid() and model.weights[0] == sum(zlib.crc32(str(k).encode()) % 4 != 2 for k in range(40))
