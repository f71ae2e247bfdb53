"""Scoring documents by masked pseudo-likelihood.

A small window network predicts every token from the two tokens on either side, itself unseen. The sum of the
tokens' conditional log-probabilities scores a document. The vocabulary is all words of the corpus: the network
predicts the most frequent ones themselves and of the others a bucket, and a word has its share of the bucket's tokens
in the whole corpus. Shares of rare words are joined in by a shuffle, however many there are.

Every document is trained on, once. Documents are dealt to shards by a hash of what they hold, and as many shards as
the corpus has tokens for each train their own copy of the network; the copies are averaged by their tokens, and
the next round begins with the average. How the rows were partitioned has no part in that.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ceil_div, drop, released, slices, summed, words, written

#: Outputs of the network: classes of words, and words of a class. The last BUCKETS words stand for all others, by a hash.
CLASSES, PER_CLASS, BUCKETS = 128, 128, 128
VOCABULARY = CLASSES * PER_CLASS
WIDTH = 16
#: The tokens around the masked one, by their distance.
WINDOW = (-2, -1, 1, 2)
#: Tokens of a training step.
STEP_TOKENS = 8192
#: Rows whose outputs are at hand at once: they stay in a core's cache.
ROWS = 512
#: Size of logits up to which exponentials are taken as they are: 32-bit sums and shares of these are far from their ends.
WIDEST = 60.0
#: Tokens that are scored at once.
SCORED_TOKENS = 1 << 15
#: Tokens of the first round, which a single shard trains: the start that all later shards share.
FIRST_TOKENS = 1 << 19
#: Tokens of a shard of the later rounds, and how many of these rounds there are.
SHARD_TOKENS, ROUNDS = 1 << 21, 2
#: Bytes of texts that a task splits to words at once.
PORTION = 1 << 23
#: Numbers of a network that a task sums over all shards.
PIECE = 1 << 14
#: Different words that a task counts before it hands its counts on.
COUNTED_WORDS = 200_000
#: Words whose ids a task keeps.
KEPT_WORDS = 400_000
#: Words of buckets, the most frequent ones, whose shares the tasks hold; those of all further words are joined in.
HELD_SHARES = 100_000


class Network:
    """Context embeddings by position, a hidden layer, and a softmax over classes and over the words of a class."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        small = lambda *s: (rng.normal(size=s) * 0.1).astype(np.float32)
        self.p = [small(len(WINDOW), VOCABULARY + 1, WIDTH), np.zeros(WIDTH, np.float32), small(WIDTH, CLASSES), np.zeros(CLASSES, np.float32), small(CLASSES, WIDTH, PER_CLASS), np.zeros((CLASSES, PER_CLASS), np.float32)]
        self.squares = [np.full_like(x, 1e-4) for x in self.p]

    def state(self, squares: bool) -> np.ndarray:
        """Parameters, and the squares that set their steps if these are wanted, as one vector."""
        return np.concatenate([x.ravel() for x in (*self.p, *(self.squares if squares else ()))])

    def become(self, v: np.ndarray) -> None:
        """Takes up parameters, and squares if v has them."""
        at = 0
        for part in (self.p, self.squares):
            for i, x in enumerate(part if at < len(v) else ()):
                part[i] = v[at : at + x.size].reshape(x.shape).astype(np.float32)
                at += x.size

    def _hidden(self, context: np.ndarray) -> np.ndarray:
        e, b = self.p[0], self.p[1]
        h = np.take(e[0], context[0], axis=0)
        h += b
        for k in range(1, len(WINDOW)):
            h += np.take(e[k], context[k], axis=0)
        return np.tanh(h, out=h)

    def log_probability(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of each target given its context (a row for each place of the window)."""
        return self._forward(context, target, None)

    def _forward(self, context: np.ndarray, target: np.ndarray, grads: list | None, sparse: bool = False) -> np.ndarray:
        _, _, wc, bc, ww, bw = self.p
        n = len(target)
        order = np.argsort(target.astype(np.uint16), kind="stable")  # tokens of a class, and of a word, lie together from here
        context, target = np.take(context, order, axis=1), target[order]
        x = self._hidden(context)
        h = np.concatenate([x, np.ones((n, 1), x.dtype)], axis=1)  # the one is for the biases
        start = _starts(target)
        word = target[start].astype(np.intp)  # the different targets
        times = np.diff(start, append=n)
        top, low = _weights(wc, bc), _weights(ww, bw)
        cls, place = word // PER_CLASS, word % PER_CLASS
        own = np.repeat(top.T[cls, : WIDTH + 1] + low[cls, : WIDTH + 1, place], times, axis=0)
        out = np.einsum("ij,ij->i", h, own)
        edges = np.searchsorted(target, np.arange(CLASSES + 1) * PER_CLASS).tolist()
        wide, share = _wide(top), None
        if grads is not None:
            share = wc.dtype.type(1 / n)
            own *= -share
            dh, gc, gw = own[:, :WIDTH], np.zeros_like(top[:-1]), np.zeros_like(low[:, :-1])
        for at in range(0, n, ROWS):
            part = slice(at, at + ROWS)
            z, d, g = _softmax(h[part], top, wide, share)
            out[part] -= z
            if grads is not None:
                dh[part] += d
                gc += g
        wide = _wide(low)
        for c, end in _groups(edges):
            first, last = edges[c], edges[end]
            if end == c + 1:
                for at in range(first, last, ROWS):
                    part = slice(at, min(at + ROWS, last))
                    z, d, g = _softmax(h[part], low[c], wide, share)
                    out[part] -= z
                    if grads is not None:
                        dh[part] += d
                        gw[c] += g
                continue
            # small classes at once, filled up to the largest with rows that count for nothing
            begin, sizes = np.array(edges[c:end]), np.diff(edges[c : end + 1])
            at = np.arange(sizes.max())
            real = at < sizes[:, None]
            z, d, g = _softmax(np.take(h, np.minimum(begin[:, None] + at, n - 1), axis=0), low[c:end], wide, share if share is None else (real * share)[..., None])
            real = np.flatnonzero(real)
            out[first:last] -= np.take(z, real)
            if grads is not None:
                dh[first:last] += np.take(d.reshape(-1, WIDTH), real, axis=0)
                gw[c:end] = g
        if grads is not None:
            seen = np.concatenate([_sums(x, start), times[:, None].astype(x.dtype)], axis=1) * share
            gw[cls, :, place] -= seen
            first = _starts(cls)
            gc[:, cls[first]] -= np.add.reduceat(seen, first, axis=0).T
            dh = dh * (1 - x * x)
            grads += [None, dh.sum(0), gc[:WIDTH], gc[WIDTH], gw[:, :WIDTH], gw[:, WIDTH]]
            parts = []
            for k in range(len(WINDOW)):
                o = np.argsort(context[k].astype(np.uint16), kind="stable")
                ids = context[k][o]
                start = _starts(ids)
                parts.append((ids[start], _sums(np.take(dh, o, axis=0), start)))
            if sparse:
                grads[0] = parts
            else:
                grads[0] = np.zeros_like(self.p[0])
                for k, (rows, g) in enumerate(parts):
                    grads[0][k][rows] = g
        back = np.empty_like(out)
        back[order] = out
        return back

    def step(self, context: np.ndarray, target: np.ndarray, rate: float = 0.15) -> float:
        """A step of Adagrad on these tokens; their mean log-probability before it."""
        grads: list = []
        out = self._forward(context, target, grads, sparse=True)
        for k, (rows, g) in enumerate(grads[0]):
            sq = np.take(self.squares[0][k], rows, axis=0)
            sq += g * g
            _put(self.squares[0][k], rows, sq)
            new = np.take(self.p[0][k], rows, axis=0)
            new -= rate * g / np.sqrt(sq)
            _put(self.p[0][k], rows, new)
        for x, g, sq in zip(self.p[1:], grads[1:], self.squares[1:], strict=True):
            d = g * g
            sq += d
            np.sqrt(sq, out=d)
            np.divide(g, d, out=d)
            d *= rate
            x -= d
        return float(out.mean())


def _put(table: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Sets rows of the table, each as one item, which is faster than number by number."""
    item = f"V{table.shape[1] * table.itemsize}"
    table.view(item)[:, 0][rows] = values.astype(table.dtype, copy=False).view(item)[:, 0]


def _starts(x: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin."""
    return np.concatenate([[0], np.flatnonzero(x[1:] != x[:-1]) + 1])[: len(x)]


def _sums(x: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The sum of each run of rows."""
    pairs = x.view(np.complex64 if x.dtype == np.float32 else np.complex128)  # two columns at a time
    return np.add.reduceat(pairs, start, axis=0).view(x.dtype)


def _weights(w: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Weights, below them biases, below them ones: times (h, 1) it gives logits, and outputs times it give their sum too."""
    return np.concatenate([w, b[..., None, :], np.ones_like(b)[..., None, :]], axis=-2)


def _wide(w: np.ndarray) -> bool:
    """Whether logits could be so large, as no h is beyond 1, that their exponentials leave the numbers of 32 bits."""
    return not np.abs(w[..., :-1, :]).sum(-2).max() < WIDEST


def _softmax(h: np.ndarray, w: np.ndarray, wide: bool, share) -> tuple:
    """For rows h (with a one at the end) and _weights w, or for a stack of both: the logarithm of each row's sum of
    exponentials and, if a row's share in the mean is given, the gradients of its mean in h and in w (with biases).

    The exponentials are only read as they are: what divides them goes to the much narrower h.
    """
    p = np.matmul(h, w[..., :-1, :])
    most = 0
    if wide:
        most = p.max(-1, keepdims=True)
        p -= most
        most = most[..., 0]
    np.exp(p, out=p)
    if share is None:
        return np.log(p @ np.ones(p.shape[-1], p.dtype)) + most, None, None
    d = np.matmul(p, w.swapaxes(-1, -2))
    total = d[..., -1:]
    scale = share / total
    g = np.matmul((h * scale).swapaxes(-1, -2), p)
    return np.log(total[..., 0]) + most, d[..., :WIDTH] * scale, g


def _groups(edges: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of classes (first, end), by the tokens' edges: together at most ROWS rows if each is filled up to the largest, and few of them filled up. None without tokens is alone."""
    at = 0
    while at < len(edges) - 1:
        end, most = at + 1, edges[at + 1] - edges[at]
        while end < len(edges) - 1:
            larger = max(most, edges[end + 1] - edges[end])
            filled = larger * (end + 1 - at)
            if filled > min(ROWS, 1.3 * (edges[end + 1] - edges[at]) + 128):
                break
            end, most = end + 1, larger
        if most:
            yield at, end
        at = end


def _bucket(word: bytes) -> int:
    """The id that stands for a word outside the vocabulary."""
    return VOCABULARY - BUCKETS + zlib.crc32(word) % BUCKETS


class _Ids(dict):
    """Word ids; those of words outside the vocabulary come from a hash, and are kept until there are too many."""

    def __missing__(self, word: str) -> int:
        out = _bucket(word.encode("utf-8", "surrogatepass"))
        if len(self) < KEPT_WORDS:
            self[word] = out
        return out


class Vocabulary:
    def __init__(self, frequent: list[str]):
        self.frequent = frequent[: VOCABULARY - BUCKETS]
        self.ids = _Ids((w, i) for i, w in enumerate(self.frequent))

    def __reduce__(self):
        return Vocabulary, (self.frequent,)

    def __call__(self, text: str | None) -> np.ndarray:
        return self.of(words(text, fold=True))

    def of(self, ws: list[str]) -> np.ndarray:
        return np.fromiter(map(self.ids.__getitem__, ws), np.int32, len(ws))


def windows(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context, target and document number of every token; beyond a document's ends stands the id VOCABULARY."""
    pad = np.full(2, VOCABULARY, np.int32)
    line = np.concatenate([pad, *(x for d in docs for x in (d, pad))])
    lengths = np.array([len(d) for d in docs])
    own = np.repeat(np.arange(len(docs)), lengths)
    at = np.arange(lengths.sum()) + 2 * (own + 1)
    return np.stack([line[at + k] for k in WINDOW]), line[at], own


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n: how often each word stands in all documents (column text), A-Z lower-cased."""

    @released
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in _portions(batches, 0):
            found = _words_of(batch[0])[1].value_counts()
            held.append(pa.table({"word": found.field(0), "n": found.field(1)}))
            size += len(found)
            if size > 2 * COUNTED_WORDS:
                held = [_counts(held)]
                size = len(held[0])
                if size > COUNTED_WORDS:
                    yield from held[0].to_batches()
                    held, size = [], 0
        if held:
            yield from _counts(held).to_batches()

    return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame) -> Vocabulary:
    """The most frequent words of all documents (column text), A-Z lower-cased; ties by the word."""
    return _vocabulary(word_counts(docs))


def _vocabulary(counts: DataFrame) -> Vocabulary:
    return Vocabulary([r.word for r in counts.orderBy(F.desc("n"), "word").limit(VOCABULARY - BUCKETS).collect()])


def shares(counts: DataFrame, vocab: Vocabulary) -> tuple[dict[str, float], DataFrame]:
    """log p(word | bucket) of the words outside the vocabulary: the HELD_SHARES most frequent, and a table (word, share) of the others."""
    kept = counts.sparkSession.createDataFrame([(w,) for w in vocab.frequent], "word string")
    rest = counts.join(F.broadcast(kept), "word", "left_anti").withColumn("bucket", F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(BUCKETS)).cast("int"))
    sums = rest.groupBy("bucket").agg(F.sum("n").alias("total"))
    rest = written(rest.join(F.broadcast(sums), "bucket").select("word", "n", F.log(F.col("n") / F.col("total")).alias("share")), "shares")
    top = rest.orderBy(F.desc("n"), "word").limit(HELD_SHARES).collect()
    if len(top) < HELD_SHARES:
        return {r.word: r.share for r in top}, rest.where("false").select("word", "share")
    n, word = top[-1].n, top[-1].word
    return {r.word: r.share for r in top}, rest.where((F.col("n") < n) | (F.col("n") == n) & (F.col("word") > word)).select("word", "share")


def _counts(parts: list[pa.Table]) -> pa.Table:
    """The counts (word, n) of all parts, a row for each word."""
    out = pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("n", "sum")])
    return out.select(["word", "n_sum"]).rename_columns(["word", "n"])


def _portions(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches with at most PORTION bytes in this column of texts, or of one row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(), dtype=np.int64)
        at = 0
        while at < len(ends):
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PORTION, "right")))
            yield batch.slice(at, end - at)
            at = end


def _words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """How many words each text has, and all of these words: those of `words`, with A-Z lower-cased."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))  # at space and U+0009 to U+000D
    flat = split.flatten()
    real = pc.not_equal(flat, "")
    row = np.repeat(np.arange(len(texts)), pc.fill_null(split.value_lengths(), 0).to_numpy())
    return np.bincount(row[real.to_numpy(zero_copy_only=False)], minlength=len(texts)), flat.filter(real)


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)


def _train(network: Network, ids: Iterator[np.ndarray]) -> int:
    """Trains on each document's tokens, in steps of some STEP_TOKENS; how many tokens there were."""
    total, held, size = 0, [], 0

    def use(docs: list[np.ndarray]) -> None:
        context, target, _ = windows(docs)
        parts = max(1, round(len(target) / STEP_TOKENS))
        for k in range(parts):  # strided: each step has tokens of all documents at hand
            network.step(np.ascontiguousarray(context[:, k::parts]), np.ascontiguousarray(target[k::parts]))

    for d in ids:
        total += len(d)
        for at in range(0, len(d), 1 << 17):
            held.append(d[at : at + (1 << 17)])
            size += len(held[-1])
            if size >= 4 * STEP_TOKENS:
                use(held)
                held, size = [], 0
    if size:
        use(held)
    return total


def _encoded(docs: DataFrame, vocab: Vocabulary, held: dict[str, float]) -> DataFrame:
    """h, doc_id, tokens, ids (16-bit numbers), held (the sum of the shares that are held) and rare (the other words of buckets) of every row."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array([*vocab.frequent, *held], pa.string())
        known_ids = np.array([*range(len(vocab.frequent)), *map(_bucket, (w.encode() for w in held))], np.uint16)
        known_shares = np.array([*(0.0 for _ in vocab.frequent), *held.values()])
        for batch in _portions(batches, 2):
            tokens, flat = _words_of(batch[2])
            flat = flat.dictionary_encode()
            different, place = flat.dictionary, flat.indices.to_numpy()
            found = pc.fill_null(pc.index_in(different, value_set=known), -1).to_numpy()
            new = np.flatnonzero(found < 0)
            ids, share = np.zeros(len(found), np.uint16), np.zeros(len(found))
            old = np.flatnonzero(found >= 0)
            ids[old], share[old] = known_ids[found[old]], known_shares[found[old]]
            ids[new] = np.fromiter(map(_bucket, different.take(pa.array(new)).cast(pa.binary()).to_pylist()), np.uint16, len(new))
            row = np.repeat(np.arange(len(tokens)), tokens)
            rare = np.flatnonzero(np.take(found, place) < 0)
            columns = [
                pa.array(tokens, pa.int64()),
                pa.Array.from_buffers(pa.binary(), len(tokens), [None, pa.py_buffer(_offsets(2 * tokens)), pa.py_buffer(np.take(ids, place))]),
                pa.array(np.bincount(row, np.take(share, place), len(tokens))),
                pa.ListArray.from_arrays(_offsets(np.bincount(row[rare], minlength=len(tokens))), different.take(pa.array(place[rare]))),
            ]
            yield pa.RecordBatch.from_arrays([batch[0], batch[1], *columns], names=["h", "doc_id", "tokens", "ids", "held", "rare"])

    rows = docs.select(F.xxhash64("doc_id", "text").alias("h"), "doc_id", "text")
    return rows.mapInArrow(run, "h long, doc_id long, tokens long, ids binary, held double, rare array<string>")


def train(docs: DataFrame, vocab: Vocabulary) -> Network:
    """The network of these documents (doc_id, text)."""
    encoded = written(_encoded(docs.select("doc_id", "text"), vocab, {}).select("h", "doc_id", "tokens", "ids"), "encoded")
    out = _trained(encoded)
    drop(encoded)
    return out


def _trained(encoded: DataFrame) -> Network:
    """Trains in rounds: each document (h, ids) has its round and its shard by its hash."""
    network = Network()
    tokens = int(encoded.agg(F.sum("tokens")).first()[0] or 0)
    if not tokens:
        return network
    # bits of the hash: the lowest 20 for the round, the next ones for the shard
    first = min(1.0, FIRST_TOKENS / tokens)
    place = F.pmod("h", F.lit(1 << 20)) / F.lit(float(1 << 20))
    edges = [0.0, first, *(first + (1 - first) * (k + 1) / ROUNDS for k in range(ROUNDS))]
    for k, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
        if low < high:
            shards = 1 if k == 0 else max(1, round(tokens * (high - low) / SHARD_TOKENS))
            shard = F.pmod(F.shiftright("h", 20), F.lit(shards)).cast("int")
            _round(network, encoded.where((place >= low) & (place < high)).select(shard.alias("shard"), "h", "ids"), shards, k == 0)
    return network


def _round(network: Network, rows: DataFrame, shards: int, squares: bool) -> None:
    """Trains a copy of the network on each shard of the rows (shard, h, ids), in the order of the hash; leaves the average, of the squares too if asked."""
    start = network.state(True)

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: list = []  # the shard at hand; a task may have several

        def documents(shard: int, batch: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
            while batch is not None:
                number = batch["shard"].to_numpy()
                end = int(np.searchsorted(number, shard, "right"))
                for x in batch["ids"].slice(0, end).to_pylist():
                    yield np.frombuffer(x, np.uint16).astype(np.int32)
                if end < batch.num_rows:
                    own.append(batch.slice(end))
                    return
                batch = next(rest, None)

        rest = slices(batches)
        batch = next(rest, None)
        while batch is not None:
            copy = Network()
            copy.become(start)
            tokens = _train(copy, documents(batch["shard"][0].as_py(), batch, rest))
            if tokens:
                v = np.concatenate([copy.state(squares) * np.float32(tokens), np.array([tokens], np.float32)])
                yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary())], names=["v"])
            batch = own.pop() if own else None

    dealt = rows.repartition(shards, "shard").sortWithinPartitions("shard", "h", "ids")
    copies = written(dealt.mapInArrow(run, "v binary"), "networks")
    total = summed(copies, len(network.state(squares)) + 1, PIECE, np.float32)
    drop(copies)
    if total is not None:
        network.become(total[:-1] / total[-1])


def pseudo_likelihood(docs: DataFrame) -> DataFrame:
    """doc_id, tokens, log_likelihood (the sum over all tokens) and per_token of every row; trains and scores.

    Null, empty or wordless text: 0 tokens, log_likelihood 0, per_token null. Very long texts are scored whole, in
    blocks of tokens. Null doc_id, ties and repeated rows: a row each, with equal scores for rows alike. Empty table: no
    rows. Extra columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = written(word_counts(rows), "counts")
    vocab = _vocabulary(counts)
    held, further = shares(counts, vocab)
    encoded = written(_encoded(rows, vocab, held), "encoded")
    network = _trained(encoded.select("h", "tokens", "ids"))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            ids = [np.frombuffer(x, np.uint16).astype(np.int32) for x in batch["ids"].to_pylist()]
            total = np.zeros(len(ids))
            context, target, own = windows(ids)
            for at in range(0, len(target), SCORED_TOKENS):
                lp = network.log_probability(context[:, at : at + SCORED_TOKENS], target[at : at + SCORED_TOKENS])
                total += np.bincount(own[at : at + SCORED_TOKENS], lp.astype(float), len(ids))
            total += batch["held"].to_numpy()
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["tokens"], pa.array(total), batch["rare"]], names=["doc_id", "tokens", "total", "rare"])

    scored = encoded.select("doc_id", "tokens", "ids", "held", "rare").mapInArrow(run, "doc_id long, tokens long, total double, rare array<string>")
    scored = written(scored.withColumn("row", F.monotonically_increasing_id()), "scores")
    parts = scored.select("row", F.explode("rare").alias("word")).join(further, "word").groupBy("row").agg(F.sum("share").alias("share"))
    parts = written(parts, "shares-of-rows")
    drop(encoded, counts)
    total = F.col("total") + F.coalesce("share", F.lit(0.0))
    out = scored.drop("rare").join(parts, "row", "left").select("doc_id", "tokens", total.alias("log_likelihood"))
    return out.withColumn("per_token", F.when(F.col("tokens") > 0, F.col("log_likelihood") / F.col("tokens")))
