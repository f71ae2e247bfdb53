import numpy as np
import pytest

from quillspan.llm.ann import nearest
from quillspan.llm import topk
from quillspan.llm.topk import ImpactBlock, Tally, exact_top_k, top


def usable(rows, zero):
    out = []
    for r in rows:
        v = r.embedding
        if r.vec_id is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        if zero or any(v):
            out.append((r.vec_id, np.pad(np.array(v, float), (0, 64 - len(v)))))
    return out


def brute_top(rows, every=20, k=20):
    e = [(i, np.floor(64 * v)) for i, v in usable(rows, True)]
    out = []
    for i, q in e:
        if i % every == 0:
            scores = sorted((-int(q @ v), j) for j, v in e if j != i)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)]
    return sorted(out)


def brute_near(rows, every=100, k=10):
    e = usable(rows, False)
    out = {}
    for i, q in e:
        if i % every == 0:
            out[i] = sorted((float(np.sqrt(((q - v) ** 2).sum())), j) for j, v in e if j != i)[:k]
    return out


@pytest.fixture(scope="module")
def odd(spark):
    v = [1.0] * 64
    rows = [(0, v), (20, None), (40, [float("nan")] * 64), (60, [None] * 64), (80, [float("inf")] * 64), (100, [0.0] * 64), (120, v), (1, v), (2, [-x for x in v]), (None, v), (3, [0.5] * 10), (200, []), (5, v), (6, [-0.0] * 64)]
    return spark.createDataFrame([(*r, 1, 0.5, 3) for r in rows], "vec_id long, embedding array<float>, rank int, score double, list int")


def test_top_k(spark):
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert sorted(map(tuple, exact_top_k(e).collect())) == brute_top(e.collect())


def test_top_k_odd(spark, odd):
    assert sorted(map(tuple, exact_top_k(odd).collect())) == brute_top(odd.collect())
    assert exact_top_k(odd.limit(0)).count() == 0


def test_top_proof_holds_on_any_shape():
    rng = np.random.default_rng(4)
    for spread in (1.0, 8.0, 100.0):
        x = np.floor(rng.normal(size=(700, 16)) * spread * rng.exponential(size=(1, 16)))
        x[300:] = x[rng.integers(0, 300, 400)]  # ties
        ids = rng.permutation(700).astype(np.int64)
        q_at = rng.integers(0, 700, 40)
        blocks = [ImpactBlock(ids[s : s + 100], x[s : s + 100]) for s in range(0, 700, 100)]
        for n, got, score in top(ids[q_at], x[q_at], blocks, 7):
            want = sorted((-int(x[q_at[n]] @ v), i) for i, v in zip(ids.tolist(), x) if i != ids[q_at[n]])[:7]
            assert [(-int(s), int(i)) for s, i in zip(score, got)] == want


def test_top_leaves_postings_unread_by_proof():
    rng = np.random.default_rng(5)
    x = np.floor(64 * (lambda v: v / np.linalg.norm(v, axis=1, keepdims=True))(rng.normal(size=(2000, 64))))
    x[1000:] = x[:1000] + rng.integers(-3, 4, (1000, 64))
    ids = np.arange(2000)
    block = ImpactBlock(ids, x)
    lists = [(d, r, v) for segment in block.segments for d, r, v in segment]
    assert block.postings == np.count_nonzero(x) == sum(len(r) for _, r, _ in lists)
    assert all((x[r, d] == v).all() for d, r, v in lists)
    highest = [max(np.abs(v).max() for _, _, v in segment) for segment in block.segments]
    assert highest == sorted(highest, reverse=True)
    want = [sorted((-int(x[n] @ v), i) for i, v in enumerate(x) if i != n)[:5] for n in range(50)]
    plain, floored = Tally(), Tally()
    for tally, floors in ((plain, None), (floored, np.array([-float(w[-1][0]) for w in want]))):
        for n, got, score in top(ids[:50], x[:50], [block], 5, floors, tally):
            assert [(-int(s), int(i)) for s, i in zip(score, got)] == want[n]
    assert plain.all == floored.all == 50 * block.postings
    assert floored.read <= plain.read < 0.9 * plain.all


def test_top_k_over_many_cells(spark, monkeypatch):
    """Cells of a few rows, repeated vec_ids and copies: floors of the first cell lose nothing."""
    monkeypatch.setattr(topk, "CELL_VECTORS", 40)
    monkeypatch.setattr(topk, "CELL_QUERIES", 5)
    rng = np.random.default_rng(6)
    vecs = rng.normal(size=(30, 8))
    rows = [(int(i), [float(c) for c in vecs[rng.integers(0, 30)]]) for i in [*range(200), *range(190, 200), *range(280, 301)]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, exact_top_k(df).collect())) == brute_top(df.collect())
    twice = df.unionAll(df.where("vec_id % 20 = 0"))
    want = {}
    e = [(i, np.floor(64 * v)) for i, v in usable(twice.collect(), True)]
    for i, q in e:
        if i % 20 == 0:
            want.setdefault(i, []).extend((-int(q @ v), j) for j, v in e if j != i)
    want = sorted((i, n + 1, j, -s) for i, all_ in want.items() for n, (s, j) in enumerate(sorted(all_)[:20]))
    assert sorted(map(tuple, exact_top_k(twice).collect())) == want


def recall(df, rows):
    want, got = brute_near(rows), {}
    for r in df.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = total = 0
    vec = dict(usable(rows, False))
    for i, near in want.items():
        own = sorted(got.get(i, []))
        assert [r for r, _, _ in own] == list(range(1, len(near) + 1))
        assert [(s, j) for _, j, s in own] == sorted((s, j) for _, j, s in own)
        for _, j, s in own:
            assert j != i and abs(s - np.sqrt(((vec[i] - vec[j]) ** 2).sum())) <= 1e-12 * max(1, s)
        hits += sum(s <= near[-1][0] for _, _, s in own)
        total += len(near)
    assert set(got) <= set(want)
    return hits / max(1, total)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_nearest(spark, sf):
    e = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    assert recall(nearest(e), e.collect()) >= 0.9


def test_nearest_odd(spark, odd):
    assert recall(nearest(odd), odd.collect()) == 1
    assert nearest(odd.limit(0)).count() == 0


def test_nearest_among_many_copies(spark):
    copies = spark.range(9_000).selectExpr("id as vec_id", "array(cast(1.0 as float), cast(if(id % 3 = 0, 2, id % 1000) as float)) as embedding")
    assert recall(nearest(copies.where("vec_id % 100 <> 0 or vec_id < 1500")), copies.where("vec_id % 100 <> 0 or vec_id < 1500").collect()) >= 0.9
