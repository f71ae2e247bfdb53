from collections import Counter

import corpus_pipeline as cp
from quillspan.llm.common import words, written


def shingles(t):
    ws = words(t, fold=True)
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def similarity(a, b):
    return len(a & b) / max(1, len(a | b))


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in cp.STAGES[:-1]:
        docs = written(stage(spark, docs, sf), f"test-{name}")
        assert docs.columns == columns
        kept[name] = [(r.doc_id, r.text) for r in docs.collect()]
    before, after = dict(kept["toxicity"]), dict(kept["near_duplicates"])
    assert len(kept["language"]) >= 0.95 * spark.read.parquet(f"{sf}/documents.parquet").count()
    assert set(after) <= set(before) and len(after) == len(kept["near_duplicates"])
    sets = {d: shingles(t) for d, t in before.items()}
    for d in sets:  # brute force: of clear copies one stays, and clean documents stay
        alike = [o for o in sets if o != d and similarity(sets[d], sets[o]) >= 0.85]
        assert d in after or any(similarity(sets[d], sets[o]) >= 0.55 for o in sets if o != d)
        assert not (d in after and any(o in after for o in alike))
    mixed = Counter(d for d, _ in kept["mixing"])
    assert set(mixed) <= set(after) and max(mixed.values()) <= 3
    pieces = cp.packing(spark, docs, sf).collect()
    assert Counter(r.doc_id for r in pieces if r.piece == 0) == mixed


def test_odd_rows(spark, odd_docs, no_docs, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd_docs, no_docs):
        columns = docs.columns
        for _, stage in cp.STAGES[:-1]:
            docs = written(stage(spark, docs, str(tmp_path)), "odd")
            assert docs.columns == columns
        cp.packing(spark, docs, str(tmp_path)).count()


def test_run_is_the_stages(spark):
    rows = cp.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and all(0 < r.length <= 4096 for r in rows)
