"""Near-duplicate detection on SimHash fingerprints.

A fingerprint is cut to bytes, each with its position. A pair within k differing bits over B bytes shares at
least B - k positional bytes. The inverted index has posting lists by sets of a few positional bytes, so few sets that
every choice of B - k positions holds one of them: no pair is lost, and lists stay short at any size of corpus. In a
list, the positional bytes that a pair shares are tallied; pairs that reach the guaranteed number are verified on all
bits. Lists of very many fingerprints are found by a count beforehand and dealt to finer ones, at last to cells of two
blocks each, so none is held whole by a task. Only a spanning forest of the links leaves a task, never the pairs of a
group. Equal fingerprints are one entry of the index, so groups of exact copies cost nothing.

For word-shingle similarity (`similar_groups`) the fingerprint, of the distinct shingles, is wider than any useful
guarantee allows; there the lists are keyed by as many sampled sets of positional bytes as a wanted recall asks for,
and short texts by rare shingles besides. These lists only propose groups: a link counts when the shingle sets of
both whole texts have been compared.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ceil_div, drop, frombuffers, released, slices, small, words, written

SEED = 42
#: Index entries of a task, of some 50 bytes each.
ENTRIES_PER_TASK = 1_000_000
#: Fingerprints whose list sizes are counted at once.
COUNTED = 200_000
#: Entries of a list that one task takes; longer lists are dealt to finer ones. Lists of up to twice that may stay.
LIST_ENTRIES = 1 << 14
#: Entries up to which lists are compared many at a time, by the distance of entries in the sorted batch.
SHORT_LIST = 48
#: Links that a task gathers before it hands them on.
KEPT_LINKS = 200_000
#: Edges that one task joins to components; more of them go in steps.
JOINED_AT_ONCE = 200_000
#: Sets, and shingle hashes, of a block of a proposed group; a task holds two blocks.
GROUP_MEMBERS, GROUP_HASHES = 2048, 1 << 19
#: Shingles that are hashed at once; longer texts go through in blocks.
BLOCK = 1 << 20
#: Distinct shingles up to which a text also meets others by shingles: the bits of so few are too coarse for the model.
SHORT = 32
#: The share of differing bits of the least favourable pair of sets at 0.8: four shingles, and the same four with a fifth.
LEAST_FAVOURABLE = 3 / 16
#: 64-bit words of a wide fingerprint that its index entries carry.
CARRIED = 3
_LANES = np.uint64(0x0101010101010101)
_SHIFTS = np.arange(8, dtype=np.uint64)
#: Fixed odd multipliers that derive the further 64-bit words of wide fingerprints.
_MULTIPLIERS = [(0x9E3779B97F4A7C15 * (2 * k + 1) | 1) & (2**64 - 1) for k in range(64)]


def shingle_hashes(ws: list[str], n: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of each n-word shingle, space-joined, in blocks; of the whole sequence if it is shorter."""
    if not ws:
        return
    text = " ".join(ws)
    if text.isascii():
        data, lengths = text.encode(), np.fromiter(map(len, ws), np.int64, len(ws))
    else:
        data = text.encode("utf-8", "surrogatepass")
        lengths = np.fromiter((len(w.encode("utf-8", "surrogatepass")) for w in ws), np.int64, len(ws))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = max(1, len(ws) - n + 1)
    starts, ends = starts[:last], ends[min(n, len(ws)) - 1 :]
    h = xxhash.xxh64_intdigest
    for at in range(0, last, BLOCK):
        s, e = starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist()
        yield np.fromiter((h(data[i:j], SEED) for i, j in zip(s, e, strict=True)), np.uint64, len(s))


def _ones(h: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits of each column is set, least significant first. Counts in byte lanes, at most 255 rows to a lane."""
    n, k = h.shape
    full = n - n % 255
    out = np.empty((k, 64), np.int64)
    for s in range(8):
        lanes = (h >> _SHIFTS[s]) & _LANES
        sums = np.concatenate([lanes[:full].reshape(-1, 255, k).sum(1), lanes[full:].sum(0, keepdims=True)])
        out[:, s::8] = sums.view(np.uint8).reshape(len(sums), k, 8).sum(0, dtype=np.int64)
    return out


def fingerprint(text: str | None, n: int = 4, width: int = 64) -> bytes:
    """The SimHash of a text, most significant byte first: a bit is 1 if set in over half the shingle hashes; no words: zero."""
    return _sketch(shingle_hashes(words(text, fold=True), n), width)


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """The distinct shingle hashes of the whole text, ascending."""
    parts = [np.unique(h) for h in shingle_hashes(words(text, fold=True), n)]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def _sketch(hashes: Iterable[np.ndarray], width: int) -> bytes:
    k = width // 64
    ones, total = np.zeros((k, 64), np.int64), 0
    further = np.array(_MULTIPLIERS[1:k], np.uint64)
    for block in hashes:
        for at in range(0, len(block), 1 << 14):
            h = block[at : at + (1 << 14), None]
            total += len(h)
            if k > 1:
                d = (h ^ (h >> np.uint64(29))) * further
                h = np.concatenate([h, d ^ (d >> np.uint64(32))], 1)
            ones += _ones(h)
    bits = (2 * ones > total)[:, ::-1] if total else np.zeros((k, 64), bool)
    return np.packbits(bits.reshape(-1)).tobytes()


def fingerprints(docs: DataFrame, n: int = 4, width: int = 64) -> DataFrame:
    """doc_id, th (a hash of the text, to tell rows with equal doc_id apart) and fp of every row."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = [fingerprint(t, n, width) for t in batch[2].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch[0], batch[1], pa.array(fps, pa.binary())], names=["doc_id", "th", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, th long, fp binary")


def shared_bytes(x: np.ndarray) -> np.ndarray:
    """The tally of positional bytes that two fingerprints share, for rows of 64-bit words of their XOR."""
    x = x | x >> np.uint64(4)
    x |= x >> np.uint64(2)
    x |= x >> np.uint64(1)
    return 8 * x.shape[1] - np.bitwise_count(x & _LANES).sum(1, dtype=np.int32)


class Filter:
    """What makes a pair a link: the tally of shared positional bytes reaches the guaranteed count, then the bits are verified."""

    def __init__(self, most_bits: int, least_bytes: int):
        self.most_bits, self.least_bytes = most_bits, least_bytes
        self.rejected = self.verified = 0

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of XORs that are links, and how many bits differ in them."""
        at = np.flatnonzero(shared_bytes(x) >= self.least_bytes) if self.least_bytes else np.arange(len(x))
        self.rejected += len(x) - len(at)
        self.verified += len(at)
        bits = np.bitwise_count(x[at]).sum(1, dtype=np.int32)
        near = bits <= self.most_bits
        return at[near], bits[near]


class Forest:
    """A spanning forest of links between nodes, any hashable values."""

    def __init__(self) -> None:
        self.up: dict = {}

    def root(self, x):
        up = self.up
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a, b) -> bool:
        """Whether this link was needed."""
        p, q = self.root(a), self.root(b)
        if p != q:
            self.up[max(p, q)] = min(p, q)
        return p != q


def _spanning(fps: np.ndarray, keep: Filter, tiers: tuple[float, ...]) -> Iterator[tuple[int, int, int]]:
    """Links, with their differing bits, that join the members of one list as all of its links would.

    A member's links to members not yet reached are followed until no more are found, so that a large group costs few
    comparisons. tiers: shares of the most differing bits; close links are followed first, wider ones only join what
    close ones leave apart.
    """
    label = np.arange(len(fps))
    for k, share in enumerate(tiers):
        own = keep if share == 1 else Filter(int(keep.most_bits * share), keep.least_bytes)
        open_ = np.arange(len(fps))
        while len(open_) > 1:
            front, open_ = [int(open_[0])], open_[1:]
            while front and len(open_):
                a = front.pop()
                hits, bits = own(fps[open_] ^ fps[a])
                if k:
                    for j, d in zip(open_[hits].tolist(), bits.tolist(), strict=True):
                        if label[j] != label[a]:
                            yield a, j, d
                            label[label == label[j]] = label[a]
                    hits = np.union1d(hits, np.flatnonzero(label[open_] == label[a]))  # a group by closer links is reached together
                else:
                    yield from ((a, j, d) for j, d in zip(open_[hits].tolist(), bits.tolist(), strict=True))
                    label[open_[hits]] = label[a]
                front.extend(open_[hits].tolist())
                open_ = np.delete(open_, hits)


def _near_in_batch(key: np.ndarray, fps: np.ndarray, keep: Filter) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All links, with their differing bits, in lists of up to SHORT_LIST entries; rows are sorted by key."""
    for d in range(1, SHORT_LIST):
        at = np.flatnonzero(key[d:] == key[:-d])
        if not len(at):
            return
        for s in range(0, len(at), 1 << 18):
            i = at[s : s + (1 << 18)]
            near, bits = keep(fps[i] ^ fps[i + d])
            yield i[near], i[near] + d, bits


def posting_sets(positions: int, shared: int, size: int) -> list[tuple[int, ...]]:
    """Sets of `size` of the positions, so that every choice of `shared` positions holds one of them. Chosen greedily."""
    if size >= shared:
        return list(combinations(range(positions), shared))
    mask = lambda c: sum(1 << i for i in c)
    left = np.array([mask(c) for c in combinations(range(positions), shared)], np.int64)
    sets = [(mask(c), c) for c in combinations(range(positions), size)]
    out = []
    while len(left):
        _, (m, best) = max(((int(((left & m) == m).sum()), (m, c)) for m, c in sets), key=lambda x: x[0])
        out.append(best)
        left = left[(left & m) != m]
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixture of each number."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _set_keys(raw: np.ndarray, k: int, positions: tuple[int, ...]) -> np.ndarray:
    """List keys of fingerprints (rows of bytes) by set number k; the number stands above 32 bits of bytes."""
    key = np.full(len(raw), k, np.int64)
    for c in positions:
        key = key << 8 | raw[:, c]
    return key << 8 * (4 - len(positions))


Deal = Callable[[np.ndarray, np.ndarray], Iterator[tuple[np.ndarray, np.ndarray]]]


def finer_lists(sets: list[tuple[int, ...]], n: int, most_bits: int) -> list[Deal]:
    """How lists of too many fingerprints of n bytes are dealt on without losing a pair: by a further byte, if the guarantee
    has one more than the sets, and then by half bytes among what is left."""
    guaranteed, out = n - most_bits, []

    def by_byte(key: np.ndarray, raw: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        number = key >> 32
        for k in np.unique(number).tolist():
            own = np.flatnonzero(number == k)
            for c in set(range(n)) - set(sets[k]):
                yield key[own] & 0xFFFFFF00 | raw[own, c] | (k * n + c) << 32, own

    def by_halves(key: np.ndarray, raw: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        number = key >> 32
        for k in np.unique(number).tolist():
            own = np.flatnonzero(number == k)
            used = {*sets[k // n], k % n} if more else set(sets[k])
            rest = sorted(set(range(n)) - used)
            halves = np.concatenate([raw[own][:, rest] >> 4, raw[own][:, rest] & 15], 1).astype(np.uint64)
            alike = halves.shape[1] - most_bits
            for j, s in enumerate(posting_sets(halves.shape[1], alike, min(3, alike))):
                bits = np.full(len(own), j, np.uint64)
                for c in s:
                    bits = bits << np.uint64(4) | halves[:, c]
                yield (_mixed(key[own]) ^ _mixed(bits + np.uint64(1) << np.uint64(20))).view(np.int64), own

    more = guaranteed > len(sets[0]) == 3
    if more:
        out.append(by_byte)
    if 2 * (n - len(sets[0]) - more) > most_bits:
        out.append(by_halves)
    return out


def _names(words_: int, named: bool) -> list[str]:
    return [f"w{k}" for k in range(words_)] + ["id"] * named


def _schema(names: list[str]) -> str:
    return ", ".join(f"{c} long" for c in names)


def _rows(columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c).view(np.int64)) for c in columns], names=names)


def _matrix(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.stack([batch[c].to_numpy().view(np.uint64) for c in names], 1)


def _long_lists(batches_of: DataFrame, keys: Callable[[pa.RecordBatch], Iterator[np.ndarray]], n: int) -> DataFrame:
    """key, n: the lists of more than LIST_ENTRIES entries, or of some more than that. keys: the list keys of a batch, array by array.

    Tasks count some COUNTED rows at a time and hand on only counts that could add up to a long list: with c such
    parts, a list that is missed has less than LIST_ENTRIES + c entries beyond what was handed on.
    """
    parts = ceil_div(n, COUNTED) + batches_of.rdd.getNumPartitions()
    least = max(1, LIST_ENTRIES // parts)

    @released
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def close() -> Iterator[pa.RecordBatch]:
            for key in keys(pa.Table.from_batches(held).combine_chunks().to_batches()[0]):
                k, c = np.unique(key, return_counts=True)
                yield _rows([k[c >= least], c[c >= least]], ["key", "n"])
            held.clear()

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= COUNTED:
                yield from close()
        if any(b.num_rows for b in held):
            yield from close()

    return batches_of.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > LIST_ENTRIES)


def _meet(lists: DataFrame, n: int, names: list[str], keep: Filter, tiers: tuple[float, ...]) -> DataFrame:
    """a, b, bits: links between entries (key and names) that share a list, as forests, task by task. n: how many entries there are."""
    words_ = [c for c in names if c != "id"]
    node = len(names) - 1 if "id" in names else 0

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, out, held, size = Forest(), [], [], 0

        def take() -> pa.RecordBatch:
            links = np.array(out, np.uint64).reshape(-1, 3)
            forest.up.clear()
            out.clear()
            return _rows(list(links.T), ["a", "b", "bits"])

        def link(ids: np.ndarray, i: Iterable[int], j: Iterable[int], bits: Iterable[int]) -> None:
            for a, b, d in zip(ids[i].tolist(), ids[j].tolist(), bits, strict=True):
                if a != b and forest.join(a, b):
                    out.append((a, b, d))

        def close() -> Iterator[pa.RecordBatch]:
            key = np.concatenate([b["key"].to_numpy() for b in held])
            rows = np.concatenate([_matrix(b, names) for b in held])
            held.clear()
            fps, ids = np.ascontiguousarray(rows[:, : len(words_)]), rows[:, node]
            edges = np.flatnonzero(np.diff(key)) + 1
            starts = np.concatenate([[0], edges])
            lengths = np.diff(np.concatenate([starts, [len(key)]]))
            short = np.repeat(lengths <= SHORT_LIST, lengths)
            at = np.flatnonzero(short)
            found = list(_near_in_batch(key[at], fps[at], keep))
            if found:
                i, j, bits = (np.concatenate(x) for x in zip(*found, strict=True))
                order = np.argsort(bits, kind="stable")
                link(ids[at], i[order], j[order], bits[order].tolist())
            for k in np.flatnonzero(lengths > SHORT_LIST).tolist():
                s, e = int(starts[k]), int(starts[k] + lengths[k])
                for a, b, d in _spanning(fps[s:e], keep, tiers):
                    link(ids[s:e], [a], [b], [d])
                if len(forest.up) > KEPT_LINKS:
                    yield take()
            if len(forest.up) > KEPT_LINKS:
                yield take()

        for b in batches:  # rows come sorted by key
            if size >= 1 << 15:
                same = int(np.searchsorted(b["key"].to_numpy(), held[-1]["key"][-1].as_py(), "right"))
                held.append(b.slice(0, same))
                size += same
                b = b.slice(same)
                if b.num_rows:
                    yield from close()
                    size = 0
            if b.num_rows:
                held.append(b)
                size += b.num_rows
        if size:
            yield from close()
        yield take()

    tasks = max(1, ceil_div(n, ENTRIES_PER_TASK))
    return lists.repartition(tasks, "key").sortWithinPartitions("key").mapInArrow(run, "a long, b long, bits long")


def _in_cells(lists: DataFrame, long: DataFrame, names: list[str]) -> DataFrame:
    """The entries of long lists (key, n) in cells of two blocks of some LIST_ENTRIES / 2 entries each: every two entries of a list share a cell."""
    half = max(1, LIST_ENTRIES // 2)
    rows = lists.join(small(long), "key").withColumn("blocks", F.ceil(F.col("n") / half).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64(*names), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))
    # an entry meets its own block in the cell of that block alone
    return rows.select(cell.alias("key"), *names)


def links_of(nodes: DataFrame, sets: list[tuple[int, ...]], most_bits: int, least_bytes: int, width: int, words_: int, named: bool = False, finer: Iterable[Deal] = (), tiers: tuple[float, ...] = (1.0,)) -> DataFrame:
    """a, b, bits: a spanning forest of the links among fingerprints (column fp, binary), task by task.

    sets: the positional bytes that key the posting lists. Entries carry the first words_ 64-bit words of a fingerprint;
    most_bits and least_bytes are of these. a and b are the fingerprints as numbers if that is all of them, and the
    column id of nodes if `named`. A column `more` (binary) may name further lists of a fingerprint, as 64-bit numbers.
    """
    further, names, size = "more" in nodes.columns, _names(words_, named), width // 8
    source = nodes.select("fp", *(["id"] if named else []), *(["more"] if further else []))

    def extra(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        keys = [np.frombuffer(b or b"", np.int64) for b in batch["more"].to_pylist()]
        return np.concatenate(keys) if keys else np.empty(0, np.int64), np.repeat(np.arange(len(keys)), [len(x) for x in keys])

    def keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        raw = frombuffers(batch["fp"], np.uint8, size)
        for k, p in enumerate(sets):
            yield _set_keys(raw, k, p)
        if further:
            yield extra(batch)[0]

    @released
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max(1, 100_000 // len(sets))):
            raw = frombuffers(batch["fp"], np.uint8, size)
            columns = list(np.ascontiguousarray(raw).view(">u8")[:, :words_].astype(np.uint64).T)
            if named:
                columns.append(batch["id"].to_numpy())
            for k, p in enumerate(sets):
                yield _rows([_set_keys(raw, k, p), *columns], ["key", *names])
            if further:
                key, own = extra(batch)
                yield _rows([key, *(c[own] for c in columns)], ["key", *names])

    def dealt(deal: Deal) -> Callable[[Iterator], Iterator]:
        @released
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, 8192):
                rows = _matrix(batch, names)
                raw = np.ascontiguousarray(rows[:, :words_].astype(">u8")).view(np.uint8)
                for key, own in deal(batch["key"].to_numpy(), raw):
                    yield _rows([key, *rows[own].T], ["key", *names])

        return run

    n = nodes.count()
    lists, long, entries = source.mapInArrow(post, _schema(["key", *names])), _long_lists(source, keys, n), n * len(sets)
    keep, out = Filter(most_bits, least_bytes), None
    for deal in (*finer, None):
        long = written(long, "long-lists")
        if not long.count():
            break
        named_long = small(long.select("key"))
        met = _meet(lists.join(named_long, "key", "left_anti"), entries, names, keep, tiers)
        out = met if out is None else out.unionAll(met)
        rest = lists.join(named_long, "key", "left_semi")
        if deal is None:
            cells = _in_cells(rest, long, names)
            spread = long.agg(F.sum(F.col("n") * F.ceil(F.col("n") / (LIST_ENTRIES // 2)))).first()[0]
            return out.unionAll(_meet(cells, int(spread), names, keep, tiers))
        lists = written(rest.mapInArrow(dealt(deal), _schema(["key", *names])), "finer-lists")
        entries = lists.count()
        long = lists.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > LIST_ENTRIES)
    met = _meet(lists, entries, names, keep, tiers)
    return met if out is None else out.unionAll(met)


def hamming_links(distinct: DataFrame, width: int = 64, most_bits: int = 4) -> DataFrame:
    """a, b, bits: a spanning forest of the links among distinct fingerprints of 64 bits (column fp), as numbers.

    Exact: pairs within most_bits share at least as many positional bytes as the index guarantees.
    """
    n = width // 8
    if width != 64 or not 0 < n - most_bits:
        raise ValueError("needs fingerprints of 64 bits, and at most 7 differing bits")
    sets = posting_sets(n, n - most_bits, min(3, n - most_bits))
    return links_of(distinct, sets, most_bits, n - most_bits, width, width // 64, finer=finer_lists(sets, n, most_bits))


def _without_cycles(edges: DataFrame) -> DataFrame:
    """The edges (a, b) that join something new in their partition: others would be carried through every step."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in batches:
            yield batch.filter(pa.array([forest.join(a, b) for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True)], pa.bool_()))
            if len(forest.up) > KEPT_LINKS:
                forest.up.clear()

    return edges.mapInArrow(run, edges.schema)


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node of each node's component, for nodes with an edge (columns a, b) other than that smallest one.

    Up to JOINED_AT_ONCE edges are joined by one task: steps cost the driver the same however few edges they have. More
    go through large-star and small-star steps in turn until they stand still; each step's edges are a table, and the one
    before it is deleted.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    left = edges.count()
    if left > JOINED_AT_ONCE:
        every, edges = edges, written(_without_cycles(edges), "edges")
        drop(every)
        left = edges.count()
    if left <= JOINED_AT_ONCE:
        found = written(_joined(edges), "roots")
        drop(edges)
        return found
    mark = _mark(edges)
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = written(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "edges")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        step = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).distinct()
        step = written(step, "edges")
        drop(edges, large)
        edges, new = step, _mark(step)
        if new == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = new


def _joined(edges: DataFrame) -> DataFrame:
    """node, root, as `components` gives them, of edges (a, b) that one task holds."""
    kind = edges.schema["a"].dataType.simpleString()

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, of = Forest(), pa.int64() if kind == "bigint" else pa.binary()
        for batch in batches:
            for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True):
                forest.join(a, b)
        found = [(x, forest.root(x)) for x in list(forest.up)]
        found = [(x, r) for x, r in found if x != r]
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], of) for k in (0, 1)], names=["node", "root"])

    return edges.coalesce(1).mapInArrow(run, f"node {kind}, root {kind}")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def grouped(keys: DataFrame, edges: DataFrame) -> DataFrame:
    """keys (doc_id, th, fp) with component_id, the smallest doc_id of the fingerprint's component, and root, its fingerprint."""
    comp = written(components(edges), "components")
    least = keys.groupBy("fp").agg(F.min("doc_id").alias("least"))
    least = least.join(comp, least.fp == comp.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = written(least, "least")
    drop(comp)
    best = least.groupBy("root").agg(F.min("least").alias("component_id"))
    named = least.select("fp", "root").join(best, "root")
    return keys.join(named, "fp")


def hamming_components(docs: DataFrame, n: int = 4, width: int = 64, most_bits: int = 4) -> DataFrame:
    """doc_id, fingerprint (hex), component_id: documents linked, at any remove, by fingerprints within most_bits.

    Exact: no link is lost. Null or empty texts, and those without words, have the zero fingerprint and are linked
    like any other; very long texts are hashed whole, in blocks. Null doc_id: has a row, and is passed over as a
    smallest doc_id unless its component has no other. Ties and repeated rows: equal fingerprints are one entry, each
    row has a row. Empty table: no rows. Extra columns are ignored.
    """
    keys = written(fingerprints(docs, n, width).withColumn("fp", F.conv(F.hex("fp"), 16, -10).cast("long")), "fingerprints")
    distinct = written(keys.select("fp").distinct().select(F.unhex(F.lpad(F.hex("fp"), 16, "0")).alias("fp")), "distinct")
    edges = hamming_links(distinct, width, most_bits)
    return grouped(keys, edges).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def sampled_positions(rows: int, width: int, similarity: float, recall: float) -> list[tuple[int, ...]]:
    """Sets of positional bytes for pairs of this Jaccard similarity: two bytes wide for up to 2^28 distinct fingerprints
    (lists of some 4,096), three for up to 2^36, then four; as many as bring a pair together with probability `recall`."""
    size = 2 if rows < 1 << 28 else 3 if rows < 1 << 36 else 4
    bytes_ = width // 8
    same = (1 - differing(similarity)) ** 8
    # sets share bytes, so a miss is reckoned for each number of bytes that the pair may share
    shared = np.array([math.comb(bytes_, k) * same**k * (1 - same) ** (bytes_ - k) for k in range(bytes_ + 1)])
    meet = np.array([math.comb(k, size) / math.comb(bytes_, size) for k in range(bytes_ + 1)])
    wanted = 1
    while shared @ (1 - meet) ** wanted > 1 - recall:
        wanted += 1
    rng, out = np.random.default_rng(7), {}
    while len(out) < wanted:  # rounds of disjoint sets, so that no byte is asked much more than another
        order = rng.permutation(bytes_)
        for at in range(0, bytes_ - size + 1, size):
            out[tuple(sorted(order[at : at + size].tolist()))] = None
    return list(out)[:wanted]


def differing(similarity: float) -> float:
    """The expected share of differing SimHash bits of two shingle sets with this Jaccard similarity."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def _prefix(n: int, similarity: float) -> int:
    """How many of its n smallest shingle hashes a set needs so that it shares one of them with every set alike."""
    return n - math.ceil(similarity * n - 1e-9) + 1 if n else 0


def alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two sets (ascending) have this Jaccard similarity or more."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both) - 1e-9


def _sets(docs: DataFrame, n: int, similarity: float, width: int) -> DataFrame:
    """doc_id, th, sid (names the shingle set), size, fp (of the set) and, for short texts, more: the hashes by which sets alike are sure to meet."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows: list[tuple] = []
            for t in batch[2].to_pylist():
                x = shingle_set(t, n)
                rows.append((hashlib.blake2b(x.tobytes(), digest_size=16).digest(), len(x), _sketch([x], width), x[: _prefix(len(x), similarity)].tobytes() if len(x) <= SHORT else None))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.binary(), pa.int64(), pa.binary(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch[0], batch[1], *columns], names=["doc_id", "th", "sid", "size", "fp", "more"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, th long, sid binary, size long, fp binary, more binary")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of sids whose sets (sid, hashes) are alike."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [[np.frombuffer(x, np.uint64) for x in batch[k].to_pylist()] for k in (2, 3)]
            keep = pa.array([alike(x, y, similarity) for x, y in zip(*sets, strict=True)], pa.bool_())
            yield batch.select(["a", "b"]).filter(keep)

    x, y = (sets.select(F.col("sid").alias(c), F.col("hashes").alias(f"h{c}")) for c in "ab")
    return pairs.join(x, "a").join(y, "b").select("a", "b", "ha", "hb").mapInArrow(run, "a binary, b binary")


def _most(width: int, p: float, slack: float) -> int:
    """Differing bits up to which pairs pass that are expected to differ in a share p of them."""
    return round(width * p + slack * math.sqrt(width * p * (1 - p)))


def _left_apart(members: DataFrame, similarity: float, width: int, slack: float) -> DataFrame:
    """a, b (sids): links that join the parts of each proposed group as all links between them would.

    members: sid, root, size, part, fp, hashes. A group is dealt to blocks of some GROUP_MEMBERS sets and GROUP_HASHES
    hashes, and every two blocks meet in a cell, so that no task holds a large group. In a cell, pairs of different parts
    whose whole fingerprints differ in no more bits than `slack` standard deviations allow are compared by their sets;
    parts that a link joined are one from then on. No pair leaves the task, only links.
    """
    most, most_short = _most(width, differing(similarity), slack), _most(width, LEAST_FAVOURABLE, slack)
    groups = members.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("hashes"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / GROUP_MEMBERS), F.ceil(F.col("hashes") / GROUP_HASHES)).cast("int")
    groups = written(groups.select("root", blocks.alias("blocks")), "groups")
    rows = members.join(small(groups), "root").withColumn("block", F.pmod(F.xxhash64("sid"), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = F.xxhash64("root", F.least("block", "other"), F.greatest("block", "other")).alias("cell")
    alone = (F.col("block") == F.col("other")).alias("alone")
    rows = rows.select(cell, "block", alone, "size", "part", "sid", "fp", "hashes")

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def close() -> pa.RecordBatch:
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held.clear()
            block, size, part = (batch[c].to_numpy() for c in ("block", "size", "part"))
            fps, apart = frombuffers(batch["fp"], np.uint64, width // 8), not batch["alone"][0].as_py()
            sid = batch["sid"].to_pylist()
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch["hashes"]]
            _, code, many = np.unique(part, return_inverse=True, return_counts=True)
            order = np.argsort(many[code] * (len(many) + 1) + code, kind="stable")  # the largest part last, it needs no turn
            out: list[tuple[bytes, bytes]] = []
            for k in range(int((code != code[order[-1]]).sum()) if len(many) > 1 else 0):
                i, rest = int(order[k]), order[k + 1 :]
                j = rest[code[rest] != code[i]]
                if apart:
                    j = j[block[j] != block[i]]
                j = j[np.minimum(size[j], size[i]) >= similarity * np.maximum(size[j], size[i]) - 1e-9]
                bits = np.bitwise_count(fps[j] ^ fps[i]).sum(1, dtype=np.int32)
                for x in j[bits <= np.where(np.minimum(size[j], size[i]) <= SHORT, most_short, most)].tolist():
                    if code[x] != code[i] and alike(sets[i], sets[x], similarity):
                        out.append((min(sid[i], sid[x]), max(sid[i], sid[x])))
                        code[code == code[x]] = code[i]
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.binary()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            for b in slices([batch]):
                while b.num_rows:
                    own = b["cell"].to_numpy()
                    if held and own[0] != held[-1]["cell"][-1].as_py():  # rows come sorted by cell
                        yield close()
                    cut = int(np.searchsorted(own, own[0], "right"))
                    held.append(b.slice(0, cut))
                    b = b.slice(cut)
        if held:
            yield close()

    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a binary, b binary").distinct()


def similar_groups(docs: DataFrame, n: int = 5, similarity: float = 0.8, width: int = 1024, recall: float = 0.99, slack: float = 4.0) -> DataFrame:
    """keys (doc_id, th, fp, root, component_id) of groups that are alike: n-word shingles, a Jaccard similarity of `similarity` or more.

    fp names the shingle set. Fingerprints propose groups: a pair at exactly `similarity` meets with probability
    `recall`, more similar ones more surely, and is proposed if the words that the index carries differ in no more bits
    than the least favourable pair of sets is expected to, plus `slack` standard deviations. Every link is then verified on
    the sets of both texts: first each set's closest proposals, then what it leaves apart of a proposed group.
    """
    keys = written(_sets(docs, n, similarity, width), "sets")
    short = F.conv(F.substring(F.hex("sid"), 1, 16), 16, -10).cast("long")
    nodes = keys.groupBy("sid").agg(F.first("fp").alias("fp"), F.first("size").alias("size"), F.first("more").alias("more"), F.min(F.struct("doc_id", "th")).alias("row"))
    nodes = written(nodes.withColumn("id", short), "nodes")
    names = written(keys.select("doc_id", "th", F.col("sid").alias("fp")), "names")
    drop(keys)
    most = _most(64 * CARRIED, max(differing(similarity), LEAST_FAVOURABLE), slack)
    sets = sampled_positions(nodes.count(), width, similarity, recall)
    forest = written(links_of(nodes, sets, most, 0, width, CARRIED, named=True, tiers=(0.35, 0.5, 0.7, 1.0)), "forest")
    # proposed groups, and the texts' sets
    roots = written(components(forest), "roots")
    roots = roots.unionAll(roots.select("root", "root").distinct())
    member = written(nodes.join(roots, nodes.id == roots.node).select("sid", "id", "size", "root", "fp", "row.doc_id", "row.th"), "members")
    drop(nodes)

    @released
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch[0], pa.array([shingle_set(t, n).tobytes() for t in batch[1].to_pylist()], pa.binary())], names=["sid", "hashes"])

    text = docs.select(F.col("doc_id").cast("long").alias("d"), F.xxhash64("text").alias("t"), F.col("text").cast("string").alias("text"))
    wanted = small(member.select("sid", "doc_id", "th"))
    text = text.join(wanted, text.d.eqNullSafe(wanted.doc_id) & (text.t == wanted.th)).select("sid", "text")
    # rows alike in doc_id and text give a set more than once
    found = written(text.mapInArrow(hashes, "sid binary, hashes binary").dropDuplicates(["sid"]), "hashes")
    ends = member.select("id", "sid")
    # every task that met a large group has a forest of it: of all these links each set tries its closest ones first
    near = forest.groupBy("a").agg(F.min(F.struct("bits", "b")).alias("n")).select("a", F.col("n.b").alias("b"))
    near = near.unionAll(forest.groupBy("b").agg(F.min(F.struct("bits", "a")).alias("n")).select(F.col("n.a").alias("a"), "b"))
    tried = near.join(ends.toDF("a", "x"), "a").join(ends.toDF("b", "y"), "b").select("x", "y")
    tried = written(tried.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "tried")
    sure = written(_verified(tried, found, similarity), "verified")
    parts = components(sure)
    left = member.join(parts, member.sid == parts.node, "left").select("sid", "size", "fp", member.root, F.xxhash64(F.coalesce(parts.root, "sid")).alias("part"))
    apart = left.groupBy("root").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x <> y").select("root")
    left = left.join(apart, "root").join(found, "sid").select("sid", "root", "size", "part", "fp", "hashes")
    more = written(_left_apart(left, similarity, width, slack), "verified")
    out = grouped(names, sure.unionAll(more))
    drop(found, tried, forest, member)
    return out


def deduplicated(docs: DataFrame, **how) -> DataFrame:
    """The rows of docs, all columns, with one document of each group of `similar_groups`: that of the smallest doc_id.

    Null, empty and wordless texts are one group; very long texts are compared whole. Rows with a null doc_id stay only
    in groups without any other. Ties: of different texts of a group that carry the smallest doc_id, that of the smallest
    text hash stays; of rows alike in doc_id and text, one. Empty table: no rows. Extra columns, whatever their names, stay.
    """
    keys = similar_groups(docs, **how)
    last = F.coalesce("doc_id", F.lit(2**63 - 1)).alias("last")
    keys = written(keys.select("th", "root", last).distinct(), "grouped-keys")
    best = keys.groupBy("root").agg(F.min(F.struct("last", "th")).alias("best"))
    gone = written(keys.join(best, "root").where(F.struct("last", "th") != F.col("best")).select("last", "th").distinct(), "gone")
    columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    key = [F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("last"), F.xxhash64("text").alias("th")]
    rows = docs.select(columns, *key).join(small(gone), ["last", "th"], "left_anti")
    # rows alike in doc_id and text are few, if there are any: the others aren't dealt anew for their sake
    again = written(docs.select(*key).groupBy("last", "th").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("last", "th"), "again")
    if again.count():
        twice = small(again)
        once = rows.join(twice, ["last", "th"], "left_semi").dropDuplicates(["last", "th"])
        rows = rows.join(twice, ["last", "th"], "left_anti").unionByName(once)
    return rows.select("row.*")
