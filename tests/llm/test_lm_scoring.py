import time

import numpy as np
import pyarrow as pa
import pytest

from quillspan.llm import lm_scoring as lm
from quillspan.llm.common import words


def test_gradients():
    rng = np.random.default_rng(0)
    net = lm.Network(1)
    net.p = [x.astype(np.float64) + rng.normal(size=x.shape) * 0.1 for x in net.p]
    context, target = rng.integers(0, lm.VOCABULARY + 1, (4, 50)), rng.integers(0, lm.VOCABULARY, 50)
    grads = []
    net._forward(context, target, grads)
    for i, g in enumerate(grads):
        for at in [tuple(rng.integers(0, s) for s in g.shape) for _ in range(6)] + [tuple(a[0] for a in np.nonzero(g))]:
            old = net.p[i][at]
            loss = []
            for d in (1e-5, -1e-5):
                net.p[i][at] = old + d
                loss.append(-net.log_probability(context, target).mean())
            net.p[i][at] = old
            assert abs((loss[0] - loss[1]) / 2e-5 - g[at]) < 1e-6


def test_probabilities_add_up():
    net = lm.Network(2)
    context = np.repeat(np.array([[3], [1023], [1024], [7]]), lm.VOCABULARY, axis=1)
    assert abs(np.exp(net.log_probability(context, np.arange(lm.VOCABULARY))).sum() - 1) < 1e-4


def test_windows():
    context, target, own = lm.windows([np.array([5, 6, 7], np.int32), np.array([], np.int32), np.array([8], np.int32)])
    v = lm.VOCABULARY
    assert target.tolist() == [5, 6, 7, 8] and own.tolist() == [0, 0, 0, 2]
    assert context.T.tolist() == [[v, v, 6, 7], [v, 5, 7, v], [5, 6, v, v], [v, v, v, v]]


def test_vocabulary_counts_everything(spark):
    docs = spark.createDataFrame([("b A a",), ("a b",), (None,), ("c",)], "text string").repartition(3)
    assert lm.vocabulary(docs).ids == {"a": 0, "b": 1, "c": 2}


def test_scores(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = lm.pseudo_likelihood(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.tokens == len(words(text[r.doc_id])) for r in rows)
    mean = sum(r.log_likelihood for r in rows) / sum(r.tokens for r in rows)
    assert mean > -np.log(lm.VOCABULARY) + 1  # far better than chance
    # documents with their words in another order are less likely
    rng = np.random.default_rng(0)
    mixed = [(d, " ".join(rng.permutation(words(t)))) for d, t in text.items()]
    vocab = lm.vocabulary(docs)
    net = lm.train(docs, vocab)
    score = lambda t: net.log_probability(*lm.windows([vocab(t)])[:2]).sum()
    assert np.mean([score(text[d]) >= score(t) for d, t in mixed]) > 0.6


def test_odd_rows(odd_docs, no_docs):
    rows = lm.pseudo_likelihood(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert (r.per_token is None) == (r.tokens == 0) and np.isfinite(r.log_likelihood)
    assert {r.tokens for r in rows if r.doc_id in (2, 3, 4)} == {0}
    assert lm.pseudo_likelihood(no_docs).count() == 0


def test_rare_words_have_their_own_probability(spark, monkeypatch):
    """Words outside the network's own: those of a bucket add up to one, by their counts, held in tasks or joined in."""
    texts = [" ".join(f"f{i}" for i in range(lm.VOCABULARY - lm.BUCKETS)) + " "] * 3
    rare = [f"r{i}" for i in range(400)]
    extra = [" ".join(rare), "r0 r0 r1"]  # r0 three times, r1 twice, the others once
    docs = spark.createDataFrame([*((i, t * 2) for i, t in enumerate(texts)), (3, extra[0]), (4, extra[1]), (4, extra[1])], "doc_id long, text string")
    counts = lm.word_counts(docs)
    vocab = lm._vocabulary(counts)
    assert all(w.startswith("f") for w in vocab.frequent)
    n = {w: 1 for w in rare} | {"r0": 5, "r1": 3}
    total = {}
    for w in rare:
        total[vocab(w)[0]] = total.get(vocab(w)[0], 0) + n[w]
    want = {w: np.log(n[w] / total[vocab(w)[0]]) for w in rare}
    scores = []
    for size in (100_000, 50):
        monkeypatch.setattr(lm, "HELD_SHARES", size)
        held, further = lm.shares(counts, vocab)
        got = held | {r.word: r.share for r in further.collect()}
        assert len(held) == min(size, 400) and got.keys() == want.keys() and all(abs(got[w] - want[w]) < 1e-9 for w in want)
        scores.append(sorted((r.doc_id, r.tokens, r.log_likelihood) for r in lm.pseudo_likelihood(docs).collect()))
    assert np.allclose(scores[0], scores[1]) and len(scores[0]) == 6
    net = lm.train(docs, vocab)
    for d, t in ((3, extra[0]), (4, extra[1])):
        alone = net.log_probability(*lm.windows([vocab(t)])[:2]).sum()
        assert abs(scores[0][d][2] - alone - sum(want[w] for w in t.split())) < 0.02 * abs(alone)


def test_scores_by_brute_force_and_however_the_rows_lie(spark, monkeypatch):
    """Every token's probability over all outcomes, one by one, times its word's share; equal under repartition."""
    import zlib
    from collections import Counter

    monkeypatch.setattr(lm, "FIRST_TOKENS", 10_000)
    monkeypatch.setattr(lm, "SHARD_TOKENS", 15_000)
    rng = np.random.default_rng(4)
    common = [f"c{i}" for i in range(40)]
    texts = [" ".join(rng.choice(common, int(rng.integers(1, 30))).tolist() + [f"own{i} Own{i // 2}"]) for i in range(40)]
    texts += [None, "", "c1 c2 " * 20, "c1 c2 " * 20]
    few = len(texts)
    fill = [f"f{i}" for i in range(lm.VOCABULARY - lm.BUCKETS - len(common))]  # so that the words of one or two documents are in buckets
    texts += [" ".join(fill[i : i + 500] * 3) for i in range(0, len(fill), 500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    counts = Counter(w for t in texts for w in words(t, fold=True))
    vocab = lm.vocabulary(docs)
    assert set(vocab.frequent) == {*common, *fill}
    bucket = lambda w: zlib.crc32(w.encode()) % lm.BUCKETS
    rest = Counter()
    for w, n in counts.items():
        if w not in vocab.frequent:
            rest[bucket(w)] += n
    net = lm.train(docs, vocab)
    e, b, wc, bc, ww, bw = (x.astype(float) for x in net.p)
    known = {w: i for i, w in enumerate(vocab.frequent)}

    def brute(text):
        ids = [known.get(w, lm.VOCABULARY - lm.BUCKETS + bucket(w)) for w in words(text, fold=True)]
        at, total = (lambda i: ids[i] if 0 <= i < len(ids) else lm.VOCABULARY), 0.0
        for i, w in enumerate(words(text, fold=True)):
            h = np.tanh(b + sum(e[k][at(i + d)] for k, d in enumerate(lm.WINDOW)))
            p, q = np.exp(h @ wc + bc), np.exp(np.einsum("i,cij->cj", h, ww) + bw)
            p = (p / p.sum())[:, None] * q / q.sum(1, keepdims=True)
            p = p.reshape(-1)
            assert abs(p.sum() - 1) < 1e-9
            total += np.log(p[ids[i]]) + (0 if w in known else np.log(counts[w] / rest[bucket(w)]))
        return total

    got = {r.doc_id: r.log_likelihood for r in lm.pseudo_likelihood(docs).collect()}
    assert all(abs(got[i] - brute(t)) <= 1e-3 * max(1, abs(got[i])) for i, t in enumerate(texts[:few]))
    for n in (7,):
        other = {r.doc_id: r.log_likelihood for r in lm.pseudo_likelihood(docs.repartition(n)).collect()}
        assert all(abs(got[i] - other[i]) <= 1e-4 * max(1, abs(got[i])) for i in got)


def plain_gradients(net, context, target):
    """Log-probabilities and gradients of weights, each softmax written out as it is defined."""
    e, b, wc, bc, ww, bw = net.p
    n, rows = len(target), np.arange(len(target))
    h = np.tanh(b + sum(e[k][context[k]] for k in range(len(lm.WINDOW))))
    cls, word = target // lm.PER_CLASS, target % lm.PER_CLASS

    def softmax(h, w, b, own):
        p = h @ w + b
        p -= p.max(1, keepdims=True)
        out = p[np.arange(len(own)), own]
        p = np.exp(p)
        s = p.sum(1, keepdims=True)
        p /= s
        p[np.arange(len(own)), own] -= 1
        p /= n
        return out - np.log(s[:, 0]), h.T @ p, p.sum(0), p @ w.T

    out, gc, gbc, dh = softmax(h, wc, bc, cls)
    gw, gbw = np.zeros_like(ww), np.zeros_like(bw)
    for c in range(lm.CLASSES):
        at = rows[cls == c]
        if len(at):
            lp, gw[c], gbw[c], d = softmax(h[at], ww[c], bw[c], word[at])
            out[at] += lp
            dh[at] += d
    dh *= 1 - h * h
    ge = np.zeros_like(e)
    for k in range(len(lm.WINDOW)):
        np.add.at(ge[k], context[k], dh)
    return out, [ge, dh.sum(0), gc, gbc, gw, gbw]


def tokens_like_text(n):
    """Contexts and targets of which few are frequent, as in a text, and many stand for rare words."""
    rng = np.random.default_rng(5)
    own = lm.VOCABULARY - lm.BUCKETS
    line = np.where(rng.random(n + 4) < 0.26, rng.integers(own, lm.VOCABULARY, n + 4), np.minimum(rng.zipf(1.2, n + 4), own) - 1).astype(np.int32)
    return np.stack([line[2 + k : 2 + k + n] for k in lm.WINDOW]), line[2 : 2 + n]


@pytest.mark.parametrize("size", [1, 400])  # of weights; the larger ones make logits whose exponentials overflow
@pytest.mark.parametrize("n", [1, 3000])
def test_blocks_of_outputs_match_plain_softmax(size, n):
    net = lm.Network(3)
    net.p = [x.astype(np.float64) * size for x in net.p]
    context, target = tokens_like_text(n)
    grads = []
    out = net._forward(context, target, grads)
    want, plain = plain_gradients(net, context, target)
    assert np.allclose(out, want, rtol=1e-9, atol=1e-9) and np.allclose(net.log_probability(context, target), want, rtol=1e-9, atol=1e-9)
    assert all(np.allclose(x, y, rtol=1e-8, atol=1e-12) for x, y in zip(grads, plain, strict=True))


def test_a_step_costs_less_than_plain_softmax():
    """The passes over tables of outputs, in training above all, are most of what op2 costs."""
    net, (context, target) = lm.Network(4), tokens_like_text(lm.STEP_TOKENS)

    def cost(f):
        began = time.thread_time()
        f()
        return time.thread_time() - began

    pairs = [(cost(lambda: net._forward(context, target, [], sparse=True)), cost(lambda: plain_gradients(net, context, target))) for _ in range(12)]
    assert np.median([a / b for a, b in pairs[2:]]) < 0.62  # 0.74 before, 0.49 now


def test_words_of_columns_are_those_of_texts():
    texts = [None, "", " ", "a\x00B\x0b\x0cc\x1c\x85d É ÀÉa\tB", "\n\nX\r\ny  Z ", "ABC"]
    for at in (0, 3, 6):
        sizes, flat = lm._words_of(pa.array(texts, pa.string()).slice(at))
        want = [words(t, fold=True) for t in texts[at:]]
        assert sizes.tolist() == [len(w) for w in want] and flat.to_pylist() == sum(want, [])
