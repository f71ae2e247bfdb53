"""Exact top-k by inner product on an impact-ordered index, score at a time.

The components of each vector are its postings. A block's postings are dealt to segments by their quantised impact
(the power of two below their absolute value), within a segment to a list for each component, and segments are
processed by descending impact: a list adds to the scores of its own vectors, for a block of queries at once. What
the segments to come can still add is bounded by the norms of the query and of the vector's postings in them. A
vector whose score so far plus that bound is under the query's floor can't be a member. The floor is the highest of
the k-th scores that are sure in this block, found in earlier blocks, and found in the first cell of vectors, which
all queries search before the others. Processing stops once that proof leaves few possible members, and those are
rescored exactly; the segments behind stay unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ceil_div, written
from .vectors import matrix, valid, widened

#: Vectors and queries of a cell; a task holds one cell.
CELL_VECTORS = 8192
CELL_QUERIES = 2048
#: Rows of the index that are worked on together, and queries.
BLOCK, QUERIES = 2048, 128
#: Cost of a component when a possible member is rescored, in postings.
RESCORING = 1


class ImpactBlock:
    """The index of a block of vectors: posting lists by segment, and for each segment the norm of all that come after it."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        row, dim = np.nonzero(x)
        value = x[row, dim]
        level = np.frexp(np.abs(value))[1]
        order = np.lexsort((row, dim, -level))
        row, dim, value, level = row[order], dim[order], value[order], level[order]
        #: For each segment its posting lists: a component, the rows that have it, and their values.
        self.segments: list[list[tuple[int, np.ndarray, np.ndarray]]] = []
        self.left: list[np.ndarray] = []
        rest = (x * x).sum(1)
        cuts = [0, *(np.flatnonzero(np.diff(level)) + 1).tolist(), len(level)]
        for s, e in zip(cuts, cuts[1:], strict=False):
            if e == s:
                continue
            edges = [s, *(np.flatnonzero(np.diff(dim[s:e])) + 1 + s).tolist(), e]
            self.segments.append([(int(dim[a]), row[a:b], value[a:b]) for a, b in zip(edges, edges[1:], strict=False)])
            rest = rest - np.bincount(row[s:e], value[s:e] ** 2, len(x))
            self.left.append(np.sqrt(np.maximum(rest, 0.0)))

    @property
    def postings(self) -> int:
        return sum(len(rows) for segment in self.segments for _, rows, _ in segment)


@dataclass
class Tally:
    """Postings that were read, times the queries that they were read for, and those that all queries would read."""

    read: int = 0
    all: int = 0


def top(query_ids: np.ndarray, q: np.ndarray, blocks: list[ImpactBlock], k: int, floors: np.ndarray | None = None, tally: Tally | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its number and the ids and scores of its k best in these blocks, by score, then by id.

    floors: a score for each query; what is under it needn't be found.
    """
    norm = np.sqrt((q * q).sum(1))
    floors = np.full(len(q), -np.inf) if floors is None else floors
    best_score = np.full((len(q), k), -np.inf)
    best_id = np.full((len(q), k), np.iinfo(np.int64).max)
    for block in blocks:
        if tally:
            tally.all += len(q) * block.postings
        # single precision where it holds every sum of these integers
        kind = np.float32 if (np.abs(q).max(0) @ np.abs(block.x).max(0)) < 1 << 24 else np.float64
        # vectors down, queries across: a posting list adds to whole rows
        possible = block.ids[:, None] != query_ids[None, :]
        live_x, live_q = np.arange(len(block.ids)), np.arange(len(q))
        at = live_x.copy()  # where a row of the block stands among the live ones, or -1
        acc = np.zeros(possible.shape, kind)
        unread, members = block.postings, []
        open_q = np.full(len(q), True)
        for segment, left in zip(block.segments, block.left, strict=True):
            own = np.ascontiguousarray(q[live_q].T, kind)
            for dim, rows, values in segment:
                rows = at[rows]
                if len(live_x) < len(at):
                    rows, values = rows[rows >= 0], values[rows >= 0]
                acc[rows] += values.astype(kind)[:, None] * own[dim]
                if tally:
                    tally.read += len(rows) * len(live_q)
            floor = np.maximum(best_score[live_q, k - 1], floors[live_q])
            bound = left[live_x, None] * norm[live_q] * (1 + 1e-12)
            if len(live_x) > k and np.isneginf(floor).any():  # the k-th highest score that is sure in this block
                sure = np.where(possible, acc - bound, -np.inf)
                floor = np.maximum(floor, np.partition(sure, len(live_x) - k, axis=0)[len(live_x) - k])
            # sums of integers are exact, only the bound is rounded
            bound += acc
            possible &= bound >= floor
            unread -= sum(len(rows) for _, rows, _ in segment)
            # a query whose possible members are rescored for less than it takes to read on stops here
            done = possible.sum(0) * RESCORING * block.x.shape[1] <= unread * len(live_x) / len(at)
            members.extend((live_q[n], live_x[possible[:, n]]) for n in np.flatnonzero(done & open_q))
            open_q &= ~done
            possible &= open_q
            rows, cols = possible.any(1), open_q
            if not cols.any():
                break
            if rows.mean() < 0.7 or cols.mean() < 0.7:
                live_x, live_q = live_x[rows], live_q[cols]
                acc, possible, open_q = acc[np.ix_(rows, cols)], possible[np.ix_(rows, cols)], open_q[cols]
                at[:] = -1
                at[live_x] = np.arange(len(live_x))
        else:
            members.extend((own, live_x[possible[:, n]]) for n, own in enumerate(live_q) if open_q[n])
        for own, rows in members:
            if not len(rows):
                continue
            score, ids = block.x[rows] @ q[own], block.ids[rows]  # exact: integers below 2^53
            if len(rows) > k:
                high = score >= np.partition(score, len(score) - k)[len(score) - k]
                score, ids = score[high], ids[high]
            score, ids = np.concatenate([best_score[own], score]), np.concatenate([best_id[own], ids])
            order = np.lexsort((ids, -score))[:k]
            best_score[own], best_id[own] = score[order], ids[order]
    for n in range(len(q)):
        found = best_score[n] > -np.inf
        yield n, best_id[n][found], best_score[n][found]


def exact_top_k(embeddings: DataFrame, every: int = 20, k: int = 20, scale: float = 64.0) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of every query, ties to the smaller vec_id.

    Queries: rows whose vec_id is divisible by `every`, each against all rows but its own. Components are
    floor(scale * x). Vectors null, or holding null or non-finite components, and rows with a null vec_id take no
    part; shorter vectors count as filled up with zeros. Of rows with the same vec_id none is a candidate for the
    others; each of them is a candidate for other queries, and as queries their results count together, by the one
    query_id. Exact where products stay below 2^53. Empty table: no rows. Extra columns are ignored.
    """
    rows = valid(embeddings, zero=True).select("vec_id", F.transform("v", lambda x: F.floor(x * F.lit(scale)).cast("double")).alias("v"))
    rows = written(rows, "impacts")
    query = F.pmod("vec_id", F.lit(every)) == 0
    n, m = rows.agg(F.count(F.lit(1)), F.count(F.when(query, 1))).first()
    xs, qs = max(1, ceil_div(n, CELL_VECTORS)), max(1, ceil_div(m, CELL_QUERIES))
    # each cell gets its share of the vectors and of the queries: the rows of neither side meet in one place
    x_cell = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(xs)).cast("int")
    q_cell = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(qs)).cast("int")
    cells = lambda start, stop: F.explode(F.sequence(F.lit(start), F.lit(stop - 1)))
    x = rows.select("vec_id", "v", x_cell.alias("a"), cells(0, qs).alias("b"), F.lit(None).cast("double").alias("floor"), F.lit(False).alias("query"))
    asked = rows.where(query).select("vec_id", "v", q_cell.alias("b"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell: list[pa.RecordBatch] = []
        now = None
        for batch in batches:  # sorted by cell
            key = batch["a"].to_numpy().astype(np.int64) * qs + batch["b"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if e == s:
                    continue
                if now is not None and key[s] != now:
                    yield from _cell(cell, k)
                    cell = []
                now = key[s]
                cell.append(batch.slice(s, e - s))
        yield from _cell(cell, k)

    def met(x: DataFrame, q: DataFrame, cells: int) -> DataFrame:
        both = x.unionAll(q.select(x.columns)).repartition(cells, "a", "b").sortWithinPartitions("a", "b")
        return both.mapInArrow(search, "query_id long, vec_id long, score long, full boolean")

    # the first cell of vectors gives each query a floor for the others
    found = met(x.where("a = 0"), asked.select("*", F.lit(0).alias("a"), F.lit(None).cast("double").alias("floor"), F.lit(True).alias("query")), qs)
    if xs > 1:
        found = written(found, "first-cell")
        floors = found.groupBy("query_id").agg(F.min("score").cast("double").alias("floor"), F.min("full").alias("full")).where("full")
        floors = floors.select(F.col("query_id").alias("vec_id"), "floor")
        q = asked.join(floors, "vec_id", "left").select("*", cells(1, xs).alias("a"), F.lit(True).alias("query"))
        found = found.unionAll(met(x.where("a > 0"), q, (xs - 1) * qs))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _cell(batches: list[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    if not batches:
        return
    t = pa.Table.from_batches(batches)
    is_query = t["query"].to_numpy(zero_copy_only=False).astype(bool)
    ids, v = t["vec_id"].to_numpy(), matrix(t["v"])
    floors = t["floor"].fill_null(-np.inf).to_numpy()[is_query]
    x_ids, x, q_ids, q = ids[~is_query], v[~is_query], ids[is_query], v[is_query]
    if not len(x_ids) or not len(q_ids):
        return
    # alike vectors together: blocks are then dropped whole more often
    order = np.lexsort((x_ids, np.abs(x).argmax(1))) if x.shape[1] else np.argsort(x_ids)
    q_order = np.lexsort((q_ids, np.abs(q).argmax(1))) if q.shape[1] else np.argsort(q_ids)
    x_ids, x, q_ids, q, floors = x_ids[order], x[order], q_ids[q_order], q[q_order], floors[q_order]
    if not x.shape[1]:
        x, q = np.zeros((len(x), 1)), np.zeros((len(q), 1))
    x, q = widened(x, q)
    blocks = [ImpactBlock(x_ids[s : s + BLOCK], x[s : s + BLOCK]) for s in range(0, len(x_ids), BLOCK)]
    for s in range(0, len(q_ids), QUERIES):
        out = list(top(q_ids[s : s + QUERIES], q[s : s + QUERIES], blocks, k, floors[s : s + QUERIES]))
        many = [len(i) for _, i, _ in out]
        qid, full = np.repeat([q_ids[s + n] for n, _, _ in out], many), np.repeat([i == k for i in many], many)
        vid, sc = np.concatenate([i for _, i, _ in out]), np.concatenate([c for _, _, c in out])
        yield pa.RecordBatch.from_arrays([pa.array(qid.astype(np.int64)), pa.array(vid.astype(np.int64)), pa.array(sc.astype(np.int64)), pa.array(full)], names=["query_id", "vec_id", "score", "full"])


ORACLE = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
