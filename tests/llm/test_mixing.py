import random
from collections import defaultdict
from fractions import Fraction

import numpy as np

from quillspan.llm.mixing import fit, mix, mixed
from quillspan.llm.common import words


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, free, out = Fraction(sum(sizes.values())), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in free}
        for s in over:
            out[s] = Fraction(3 * sizes[s])
            left -= out[s]
        free -= over
    return out


def check(docs, rows):
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in docs.collect():
        sizes[r.source] += len(words(r.text))
    want = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
    for s in sizes:
        assert abs(target[s] - float(want[s])) <= 1e-6 * max(1, float(want[s]))
    return taken, target


def test_targets_and_words(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mix(docs).collect()
    assert len(rows) == docs.count()
    taken, target = check(docs, rows)
    for s in target:
        assert abs(taken[s] - target[s]) <= max(40, 0.02 * target[s])
    again = mix(docs.repartition(3)).collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)


def test_odd_rows(odd_docs, no_docs):
    rows = mix(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    check(odd_docs, rows)
    assert mix(no_docs).count() == 0 and mixed(no_docs).count() == 0
    out = mixed(odd_docs)
    assert out.columns == odd_docs.columns


def test_hot_length_is_split(spark):
    docs = spark.range(45_000).selectExpr("id as doc_id", "concat('w x ', id) as text", "if(id % 3 = 0, 'hot', 'z') as source")
    rows = mix(docs).collect()
    taken, target = check(docs, rows)
    for s in target:
        assert abs(taken[s] - target[s]) <= 3


def test_fit_is_near():
    rng = random.Random(3)
    for _ in range(200):
        lengths = np.array(sorted(rng.sample(range(0, 400), rng.randrange(1, 30))))
        counts = np.array([rng.randrange(1, 9) for _ in lengths])
        total = int((lengths * counts).sum())
        budget = rng.randrange(0, total + 2)
        take = fit(lengths, counts, budget)
        assert (take >= 0).all() and (take <= counts).all()
        got = int((lengths * take).sum())
        reach = {0}
        for x, n in zip(lengths.tolist(), counts.tolist()):
            reach = {r + k * x for r in reach for k in range(n + 1)}
        best = min(abs(r - budget) for r in reach)
        if total <= 30_000:  # all goes through the program
            assert abs(got - budget) == best


def test_fit_is_near_with_long_documents():
    words = lambda lengths, counts, budget: int((np.array(lengths) * fit(np.array(lengths), np.array(counts), budget)).sum())
    assert words([500, 1_000_000], [1000, 1], 900_000) == 1_000_000
    assert words([150_000, 200_000, 250_000], [1, 1, 1], 400_000) == 400_000
    assert words([20, 30_000_000, 50_000_000], [100, 1, 1], 50_000_500) == 50_000_500
    rng = random.Random(4)
    for _ in range(20):
        lengths = sorted(rng.sample(range(50_000, 400_000), rng.randrange(2, 7)))
        budget = rng.randrange(1, sum(lengths))
        best = min(abs(sum(x for k, x in enumerate(lengths) if m >> k & 1) - budget) for m in range(1 << len(lengths)))
        if budget <= 2 * max(lengths):  # all goes through the program
            assert abs(words(lengths, [1] * len(lengths), budget) - budget) == best
