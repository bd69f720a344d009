import zlib

import numpy as np
import pytest

from cloudmarts.llm import quality_fm as q

SF = "/root/testdata/sf0.01"


def test_sum_of_squares_identity_equals_all_pairs():
    rng = np.random.default_rng(0)
    model = q.FactorisationMachine(0.3, rng.standard_normal(50), rng.standard_normal((50, q.FACTORS)))
    rows = [(np.array([1, 4, 9]), rng.standard_normal(3)), (np.array([0, 49]), rng.standard_normal(2))]
    got = model.logits(np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows]), np.array([0, 3]))
    for (index, value), logit in zip(rows, got, strict=True):
        want = 0.3 + sum(model.weight[i] * v for i, v in zip(index, value, strict=True))
        for a in range(len(index)):
            for b in range(a + 1, len(index)):
                want += model.factor[index[a]] @ model.factor[index[b]] * value[a] * value[b]
        assert logit == pytest.approx(want)


def test_held_out_rows_are_told_apart_and_learned_from_others_only(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = q.quality_scores(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out.doc_id]).all()
    held = out[out.held_out]
    assert ((held.predicted == 1) == (held.quality == 1)).mean() > 0.93
    assert held[held.quality == 1].predicted.mean() > 0.98
    # flipped labels of held-out rows change nothing
    flipped = labels.withColumn("quality", q.F.when(q.held_out(), 1 - q.F.col("quality")).otherwise(q.F.col("quality")))
    again = q.quality_scores(docs, flipped).toPandas()
    assert (out.set_index("doc_id").score == again.set_index("doc_id").score.loc[out.doc_id]).all()


def test_messy_rows(spark, messy):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (9, 1), (8, 0)], "doc_id long, quality int")
    out = q.quality_scores(messy, labels).toPandas()
    assert list(out.columns) == ["doc_id", "held_out", "score", "predicted"]
    assert len(out) == messy.count() and out.score.between(0, 1).all()
    assert not out[out.doc_id.isna()].held_out.any()
    assert q.keep_good(messy, labels, threshold=0.0).columns == messy.columns


def test_empty_tables(spark, messy, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert set(q.quality_scores(messy, none).toPandas().score) == {0.5}
    assert q.quality_scores(no_docs, none).count() == 0


def test_sample_bound(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    small = q.train(docs, labels, sample_rows=20)
    assert (small.weight != 0).sum() < (q.train(docs, labels).weight != 0).sum()
