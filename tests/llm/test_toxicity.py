import zlib

import numpy as np

from quillspan.llm.toxicity import calibrated, features, platt, toxicity, train, without_toxic


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(order))
    rank[order] = np.arange(1, len(order) + 1)
    p = y.sum()
    return (rank[y == 1].sum() - p * (p + 1) / 2) / (p * (len(y) - p))


def test_held_out_labels(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    rows = {r.doc_id: r for r in toxicity(docs, labels).collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows.values())
    held = [(rows[r.doc_id], r.toxic) for r in labels.collect() if rows[r.doc_id].held_out]
    y = np.array([t for _, t in held])
    assert auc(np.array([r.score for r, _ in held]), y) >= 0.93
    flagged = np.array([r.predicted for r, _ in held]) == 1
    assert y[flagged].mean() >= 0.9 and flagged[y == 1].mean() >= 0.4
    assert all(r.predicted == (r.score >= 0.7) for r in rows.values())


def test_labels_of_held_out_rows_do_not_matter(spark):
    d = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    other = labels.selectExpr("doc_id", "quality", "if(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, 1 - toxic, toxic) as toxic")
    assert sorted(toxicity(docs, labels).collect()) == sorted(toxicity(docs, other).collect())


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 1), (1, 0, 0), (2, None, 1), (None, 1, 1), (3, 1, None), (6, 1, 0)], "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    for docs, marks in ((odd_docs, labels), (odd_docs, none), (no_docs, labels)):
        rows = toxicity(docs, marks).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert without_toxic(docs, marks).columns == docs.columns


def test_unlabelled_text_with_toxic_documents():
    """The prior corrects for the toxic documents in the unlabelled text."""
    rng = np.random.default_rng(0)
    word = lambda: "w" + "".join(rng.choice(list("abcdefgh"), 4))
    doc = lambda bad: features(" ".join([word() for _ in range(40)] + (["vile", "nasty"] if bad else [])))
    unlabelled = [doc(i % 10 == 0) for i in range(1000)]
    model = train([doc(True) for _ in range(100)], unlabelled, 0.1)
    z = model.logits(unlabelled)
    assert (z[::10] > 1).all() and (np.delete(z, np.s_[::10]) < 0).all()


def test_documents_that_are_surely_toxic_score_so(spark):
    """Each has one word of many that only toxic documents have; timid scores left a part of them below the threshold."""
    rng = np.random.default_rng(1)
    word = lambda: "w" + "".join(rng.choice(list("abcdefgh"), 4))
    bad = ["vile", "nasty", "scum", "rotten", "foul", "filthy", "moron", "idiot", "loser", "trash", "clown", "dumb"]
    rows = [(i, " ".join([word() for _ in range(30)] + ([bad[int(rng.integers(len(bad)))]] if i % 10 == 0 else []))) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i, _ in rows if i % 2 == 0 or i % 7 == 0], "doc_id long, toxic int")
    kept = {r.doc_id for r in without_toxic(docs, labels).collect()}
    toxic = [i for i, _ in rows if i % 10 == 0]
    clean = [i for i, _ in rows if i % 10]
    assert sum(i not in kept for i in toxic) >= 0.95 * len(toxic) and sum(i in kept for i in clean) >= 0.99 * len(clean)


def test_calibration():
    rng = np.random.default_rng(2)
    z = rng.normal(size=20_000)
    y = (rng.random(len(z)) < 1 / (1 + np.exp(-(3 * z - 2)))).astype(int)
    slope, shift = platt(z, y, float(y.mean()))
    assert abs(slope - 3) < 0.2 and abs(shift + 2) < 0.2
    apart = platt(np.r_[np.full(50, -1.0), np.full(50, 1.0)], np.repeat([0, 1], 50), 0.5)  # finite where the labels are apart
    assert np.isfinite(apart).all() and apart[0] > 1
    assert platt(-z, y, 0.5) == (1.0, 0.0) and np.isfinite(platt(np.zeros(100), np.repeat([0, 1], 50), 0.1)).all()
    docs = [features(f"word{i % 7} vile") for i in range(40)]
    model = train(docs, [features(f"word{i % 7}") for i in range(40)], 0.1)
    of = [(i % 3, f) for i, f in enumerate(docs)]
    assert calibrated(model, of, of, of[:5], 0.1) is model
