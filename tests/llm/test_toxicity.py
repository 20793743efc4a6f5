"""Operator 8: accuracy on held-out documents, chain training, odd inputs."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cinelens.llm import logistic, toxicity as tx
from cinelens.llm.queries import op8_toxicity

from llm_cases import ODD, SF01, clashing


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.pmod(F.xxhash64(F.lit(77), "doc_id"), F.lit(4)) == 0
    chain = tx.fit_documents(docs, labels.where(~held))
    scored = tx.digest(tx.score(docs, chain, keep=["doc_id"])).withColumnRenamed("toxic", "said")
    m = scored.join(labels.where(held), "doc_id").toPandas()
    assert len(m) > 700
    assert m[m.toxic == 1].said.mean() > 0.85  # the labels themselves hold some noise
    assert m[m.toxic == 0].said.mean() < 0.01


def test_query_covers_every_document(spark, docs01):
    rows = op8_toxicity(spark, SF01).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs01)
    assert all(0 <= r[f"p_{c}"] <= 1 for r in rows for c in tx.CATEGORIES)
    assert all(r.toxic == (r.p_toxic >= 0.5) for r in rows if abs(r.p_toxic - 0.5) > 1e-5)


def _labelled(spark):
    rows = [(i, ("vile" if i % 3 == 0 else "nice") + f" text number w{i % 11}", i % 3 == 0) for i in range(300)]
    return (spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"),
            spark.createDataFrame([(r[0], int(r[2])) for r in rows], "doc_id long, toxic int"))


def test_odd_rows(spark, odd):
    docs, labels = _labelled(spark)
    chain = tx.fit_documents(docs, labels)
    out = tx.digest(tx.score(clashing(odd, "p_toxic", "row", "toxic"), chain))
    rows = out.collect()
    assert len(rows) == len(ODD) and not any(r.toxic for r in rows)
    vile = spark.createDataFrame([(1, "VILE thing"), (2, "a nice thing")], "doc_id long, text string")
    assert {r.doc_id: r.toxic for r in tx.digest(tx.score(vile, chain)).collect()} == {1: True, 2: False}


def test_repeated_and_missing_labels(spark):
    docs, labels = _labelled(spark)
    mixed = labels.unionByName(labels.where("doc_id < 30")).unionByName(
        spark.createDataFrame([(5, None), (None, 1), (99999, 1)], "doc_id long, toxic int"))
    assert list(tx.fit_documents(docs, mixed).index) == list(tx.fit_documents(docs, labels).index)


def test_without_labels_nothing_is_toxic(spark, none, odd):
    docs, labels = _labelled(spark)
    for empty in (labels.limit(0), labels.where("toxic = 0")):
        chain = tx.fit_documents(docs, empty)
        assert not any(r.toxic for r in tx.digest(tx.score(odd, chain)).collect())
    assert tx.digest(tx.score(none, tx.fit_documents(docs, labels))).collect() == []
    tx.fit_documents(none, labels)


def test_own_categories(spark):
    rows = [(i, " ".join(["rude"] * (i % 2) + ["threat"] * (i % 4 == 3) + [f"w{i % 5}", "and"]),
             i % 2, int(i % 4 == 3)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, insult int, menace int")
    chain = tx.train(df, ["insult", "menace"])
    assert chain.categories == ["insult", "menace"]
    p = tx.score(df, chain, keep=["doc_id", "insult", "menace"]).toPandas()
    assert ((p.p_menace > .5) == p.row.map(lambda r: r["menace"] == 1)).all()


def test_chain_feeds_out_of_fold_probabilities():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    first = (x[:, 0] + rng.normal(size=400) * .3 > 0).astype(float)
    second = first * (x[:, 1] > 0)
    folds = np.arange(400) % 5
    chain = tx.Chain(["=a"], ["one", "two"], 1.0)
    chain.train(x, np.c_[first, second], folds)
    assert [len(w) for w in chain.weights] == [4, 5]  # the second model sees one more column
    fed = logistic.out_of_fold(x, first, folds, 1.0)
    again = logistic.fit(np.c_[x, fed], second, 1.0)
    assert np.allclose(chain.weights[1], again)


def test_out_of_fold_models_have_not_seen_their_rows():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(200, 60)), (rng.random(200) < .5).astype(float)
    inside = logistic.predict(x, logistic.fit(x, y, 0.01))
    outside = logistic.out_of_fold(x, y, np.arange(200) % 5, 0.01)
    assert ((inside > .5) == y).mean() > .7 > ((outside > .5) == y).mean()


def test_training_rows_are_bounded_whatever_an_id_holds(spark):
    from cinelens.llm.common import bounded_sample
    rows = [(1, "vile text")] * 5000 + [(2, f"nice text {i}") for i in range(5000)] + [(3, None)] * 10
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    key = F.xxhash64("doc_id", "text")
    assert bounded_sample(docs, key, 10_000).count() == 5002  # each id and text once
    some = bounded_sample(docs, key, 1000)
    assert 800 < some.count() < 1200 and some.distinct().count() == some.count()
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    tx.fit_documents(docs, labels, train_rows=500)


def test_long_words_keep_their_beginnings():
    long = b"vile" + b"x" * 60
    assert tx.forms(long) == ["^vil", "^vile", "^vilex", "^vilexx"] and tx.forms(b"vile")[0] == "=vile"


def test_training_holds_no_second_copy_of_the_features():
    x = np.random.default_rng(3).poisson(0.3, (30_000, 60)).astype(float)
    y, chain = np.c_[x[:, 0] > 0, x[:, 1] > 0].astype(float), tx.Chain([], ["first", "last"], 1.0)
    wide = np.c_[x, np.zeros(len(x))]
    tracemalloc.start()
    chain.train_wide(wide, y, np.arange(len(x)) % 5)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 0.8 * x.nbytes
    again = tx.Chain([], ["first", "last"], 1.0)
    again.train(x, y, np.arange(len(x)) % 5)
    assert all((a == b).all() for a, b in zip(chain.weights, again.weights))


def test_features_travel_without_their_zeros():
    chain = tx.Chain(["=bad", "^wor"], ["toxic"], 1.0)
    texts = ["bad words bad", "", "nothing here", "words and worms"]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(texts), pa.array([[1], [0], [0], [1]], pa.list_(pa.int32())), pa.array([0, 1, 2, 3])], ["t", "y", "f"])
    (out,) = tx._featurizer(chain)(iter([batch]))
    whole = np.array([chain.features(t.encode()) for t in texts])
    assert len(out.column(0).flatten()) == np.count_nonzero(whole) < whole.size
    assert (tx.matrix(out.column(0), out.column(1), 6) == np.c_[whole, np.zeros((4, 2))]).all()
