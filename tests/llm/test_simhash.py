import numpy as np
import xxhash

from quillspan.llm import simhash
from quillspan.llm.simhash import Filter, Forest, deduplicated, fingerprint, grouped, hamming_components, hamming_links, posting_sets, shared_bytes


def brute_fp(text, n=4):
    import re

    ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hs = [xxhash.xxh64_intdigest(" ".join(ws[i : i + n]).encode(), 42) for i in range(max(1, len(ws) - n + 1))] if ws else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, fps, most=4):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most:
                parent[root(i)] = root(j)
    best = {}
    for i, d in enumerate(ids):
        if d is not None:
            best[root(i)] = min(best.get(root(i), d), d)
    return [best.get(root(i)) for i in range(len(ids))]


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fps = [brute_fp(t) for _, t in rows]
    want = sorted((str(d), f"{f:016x}", str(c)) for (d, _), f, c in zip(rows, fps, brute_components([d for d, _ in rows], fps)))
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in hamming_components(docs).collect())
    assert got == want


def test_documents(spark, sf):
    check(spark.read.parquet(f"{sf}/documents.parquet"))


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs)
    assert hamming_components(no_docs).count() == 0
    out = deduplicated(odd_docs)
    assert out.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in out.select("doc_id").collect()) == ["1", "2", "5", "7", "9", "None"]
    assert deduplicated(no_docs).count() == 0


def test_chains_of_fingerprints(spark):
    """Chains, long lists and groups beyond any one list, against all pairs."""
    rng = np.random.default_rng(5)
    fps = []
    for _ in range(12):
        x = int(rng.integers(0, 2**63))
        for _ in range(60):
            fps.append(x)
            for b in rng.choice(64, int(rng.integers(1, 7)), replace=False):
                x ^= 1 << int(b)
    assert linked(spark, fps) == brute_components(list(range(len(fps))), fps)


def test_components_of_few_edges_take_few_jobs(spark, monkeypatch):
    """A chain that steps need many jobs for; joined by one task and in steps it has the same components."""
    rng = np.random.default_rng(8)
    ids = rng.permutation(600).tolist()
    edges = [(a, b) for a, b in zip(ids, ids[1:]) if a % 50] + [(7, 7), (ids[3], ids[2]), (1000, 1001)]
    up = Forest()
    for a, b in edges:
        up.join(a, b)
    want = sorted((x, up.root(x)) for x in list(up.up) if up.root(x) != x)

    def found(rows, kind):
        spark.sparkContext.setJobGroup(f"{kind}", "components")
        out = sorted((r.node, r.root) for r in simhash.components(spark.createDataFrame(rows, f"a {kind}, b {kind}")).collect())
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"{kind}"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return out, jobs

    got, jobs = found(edges, "long")
    assert got == want and jobs <= 8
    name = lambda x: bytearray((x ^ 128).to_bytes(4, "little"))
    by_name, jobs = found([(name(a), name(b)) for a, b in edges], "binary")
    assert jobs <= 8
    monkeypatch.setattr(simhash, "JOINED_AT_ONCE", 100)
    assert found(edges, "long")[0] == want
    assert found([(name(a), name(b)) for a, b in edges], "binary")[0] == by_name


def linked(spark, fps):
    """The component of each fingerprint, by the index."""
    signed = lambda f: int(np.uint64(f).astype(np.int64))
    keys = spark.createDataFrame([(i, 0, signed(f)) for i, f in enumerate(fps)], "doc_id long, th long, fp long")
    distinct = spark.createDataFrame([(bytearray(int(f).to_bytes(8, "big")),) for f in sorted(set(fps))], "fp binary")
    return [r.component_id for r in grouped(keys, hamming_links(distinct)).orderBy("doc_id").collect()]


def test_long_lists_are_dealt_on(spark, monkeypatch):
    """Lists beyond what a task takes go by a further byte, by half bytes and at last in cells of two blocks; no link is lost."""
    rng = np.random.default_rng(6)
    fps = [int(x) << 8 for x in rng.integers(0, 2**20, 300)] + [int(x) for x in rng.integers(0, 2**63, 300)]
    fps += [f ^ 1 << int(rng.integers(0, 64)) ^ 1 << int(rng.integers(0, 64)) for f in fps[::3]] + [1 << 40 | 1 << i for i in range(30)]
    fps = list(dict.fromkeys(fps))
    want = brute_components(list(range(len(fps))), fps)
    for entries in (200, 20, 4):
        monkeypatch.setattr(simhash, "LIST_ENTRIES", entries)
        monkeypatch.setattr(simhash, "COUNTED", 64)
        assert linked(spark, fps) == want


def test_the_count_filter_rejects_pairs_before_verification():
    """Pairs of a list share three bytes; those without a fourth never come to the bits."""
    keep = Filter(4, 4)
    x = np.array([0x0000000000FFFFFF, 0x0000000101010101, 0x0000000001010101, 0x0000000001010107, 0x0101010101010101], np.uint64)[:, None]
    at, bits = keep(x)
    assert at.tolist() == [1, 2] or at.tolist() == [2]
    assert shared_bytes(x).tolist() == [5, 3, 4, 4, 0]
    assert keep.rejected == 2 and keep.verified == 3 and at.tolist() == [2] and bits.tolist() == [4]


def test_every_choice_of_guaranteed_bytes_holds_a_set():
    from itertools import combinations

    for n, shared, size in ((8, 4, 3), (8, 3, 3), (8, 5, 3), (8, 1, 1), (10, 6, 3)):
        sets = posting_sets(n, shared, size)
        assert all(any(set(s) <= set(c) for s in sets) for c in combinations(range(n), shared))


def test_spanning_joins_what_all_links_join():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 3, dtype=np.uint64)
    fps = np.unique(np.array([base[i % 3] ^ np.uint64(sum(1 << int(b) for b in rng.choice(20, 3, replace=False))) for i in range(700)]))
    want = brute_components(list(range(len(fps))), [int(f) for f in fps], 3)
    for tiers in ((1.0,), (0.4, 0.7, 1.0)):
        forest = Forest()
        links = [forest.join(a, b) for a, b, _ in simhash._spanning(fps[:, None], Filter(3, 0), tiers)]
        assert all(links) and [forest.root(i) for i in range(len(fps))] == want


def test_wide_fingerprint_starts_with_the_narrow_one():
    assert fingerprint("a b c d e f g", 4, 512)[:8] == fingerprint("a b c d e f g", 4)


def test_near_copies_go_and_clean_documents_stay(spark):
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    clean = [[word() for _ in range(300)] for _ in range(60)]
    rows = [(i, " ".join(w)) for i, w in enumerate(clean)]
    for i in range(30):
        w = list(clean[i])
        for at in rng.choice(300, 4, replace=False):
            w[at] = word()
        rows += [(100 + i, " ".join(w)), (200 + i, " ".join(clean[i]))]
    out = deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in out.collect()) == list(range(60))


def _edited(rng, shared, own, name):
    """Two texts of distinct five-word shingles, `shared` of them the same and `own` more in each."""
    same = [f"{name}s{i}" for i in range(shared + 4)]
    return " ".join(same + [f"{name}a{i}" for i in range(own)]), " ".join(same + [f"{name}b{i}" for i in range(own)])


def test_links_are_exact_on_both_sides_of_the_threshold(spark):
    """At 0.8 (8k of 10k shingles) all pairs link, just below none does."""
    rng, rows, gone = np.random.default_rng(3), [], 0
    for k in range(300):
        size = int(rng.choice([1, 2, 5, 30, 100]))
        a, b = _edited(rng, 8 * size, size, f"p{k}")
        rows += [(2 * k, a), (2 * k + 1, b)]
    for k in range(300, 500):
        size = int(rng.choice([1, 2, 5, 30, 100]))
        a, b = _edited(rng, 8 * size - 1, size, f"p{k}")
        rows += [(2 * k, a), (2 * k + 1, b)]
    left = {r.doc_id for r in deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert left >= set(range(600, 1000))  # clean documents stay
    assert left >= set(range(0, 600, 2))
    gone = sum(k not in left for k in range(1, 600, 2))
    assert gone >= 0.97 * 300  # of pairs at exactly 0.8, proposed with probability 0.99


def test_repeated_lines_count_once(spark):
    line = " ".join(f"line{i}" for i in range(12))
    own = [" ".join(f"own{d}x{i}" for i in range(150)) for d in range(3)]
    rows = [(0, f"{line} " * 400 + own[0]), (1, f"{line} " * 400 + own[1]), (2, f"{own[2]} " + f"{line} " * 2), (3, f"{own[2]} " + f"{line} " * 300)]
    left = {r.doc_id for r in deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert left == {0, 1, 2}
