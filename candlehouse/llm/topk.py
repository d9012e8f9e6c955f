"""Exact top-k inner products by descending length, with rotated partial sums.

Vectors are whole numbers and scores are exact, in double arithmetic where lengths allow and in whole numbers beyond; a score that a 64-bit
number can't hold is cut to the nearest one that it can. Candidates are cut into bands of falling length; each band lies in
cells with blocks of queries, and a cell is one task's work on a bounded number of rows:

1. A first pass scores every query against the ``seeds`` longest candidates. The k-th best score found is a floor under the final k-th best.
2. By Cauchy-Schwarz no score exceeds |q| |x|. A query joins a band only if |q| times the band's greatest length reaches its floor.
3. In a cell candidates go by falling length in blocks. Queries and candidates are rotated by the singular vectors of all candidates,
   so the leading coordinates carry most of a product: partial sum + |rest of q| |rest of x| bounds the score. Candidates that no query
   can use any more are skipped, all others are scored exactly, and floors rise as blocks go by.

A cell returns k rows for each of its queries; the best k of these are the result. Ties go to the smaller id, so
a candidate is skipped only if its bound is below the floor, never if equal.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlehouse.llm.common import checkpoint

#: Candidates of a cell, queries of a cell, candidates of one block within a cell.
BAND_ROWS, QUERY_ROWS, BLOCK = 8192, 2048, 1024
#: Longest candidates of the first pass.
SEEDS = 4096
#: Scores below the first are exact in double arithmetic, those below the second in 64-bit whole numbers.
EXACT, LONG = float(2**52), float(2**62)
#: Stands for no score; whole scores stay above it.
NONE = -(2**63)


def whole_vectors(rows: DataFrame, key: str, vector: str, scale: int = 64) -> DataFrame:
    """(id, v): floor(scale * x) of every component as a double, which holds it exactly, x being a double.

    Rows with a null vector, a null or non-finite component (or one that scaling makes infinite) are left out, as are rows with
    a null id and empty vectors.
    """
    scaled = lambda x: x.cast("double") * scale
    whole = F.transform(F.col(vector), lambda x: F.when(F.abs(scaled(x)) >= EXACT, scaled(x)).otherwise(F.floor(scaled(x)).cast("double")))
    fine = F.forall(F.col(vector), lambda x: x.isNotNull() & (F.abs(scaled(x)) < float("inf")))
    return (rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & fine)
            .select(F.col(key).cast("bigint").alias("id"), whole.alias("v")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, padded with zeros to ``width``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(float)
    n = np.diff(offsets)
    if len(n) and n.min() == n.max() == width:
        return values[offsets[0]:offsets[-1]].reshape(-1, width)
    out = np.zeros((len(n), width))
    for i, size in enumerate(n):
        out[i, :size] = values[offsets[i]:offsets[i + 1]]
    return out


class Best:
    """The k best (score, smaller id first) of each query so far."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, 0), NONE)
        self.id = np.zeros((queries, 0), dtype=np.int64)

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        """``score`` of each query against the same candidates ``ids`` (ascending); NONE where there is none."""
        if score.shape[1] > self.k:  # a stable sort leaves ties in the order of ids; ~x falls as x rises, for every x
            order = np.argsort(~score, axis=1, kind="stable")[:, :self.k]
            score, ids = np.take_along_axis(score, order, axis=1), ids[order]
        ids = np.concatenate([self.id, np.broadcast_to(ids, score.shape)], axis=1)
        score = np.concatenate([self.score, score], axis=1)
        order = np.lexsort((ids, ~score), axis=1)[:, :self.k]
        self.score = np.take_along_axis(score, order, axis=1)
        self.id = np.take_along_axis(ids, order, axis=1)

    def floors(self) -> np.ndarray:
        """A number that the kth best score is not below, for comparison with bounds that have some slack."""
        if self.score.shape[1] < self.k:
            return np.full(len(self.score), -np.inf)
        return np.where(self.score[:, -1] == NONE, -np.inf, self.score[:, -1].astype(float))


def products(q: np.ndarray, x: np.ndarray, q_len: np.ndarray, x_len: np.ndarray) -> np.ndarray:
    """All inner products of whole vectors, exactly, cut to what 64 bits hold."""
    if not len(q) or not len(x):
        return np.zeros((len(q), len(x)), np.int64)
    top_q, top_x = q_len.max(), x_len.max()
    if top_q * top_x < EXACT:
        return np.rint(q @ x.T).astype(np.int64)
    if max(top_q, top_x, top_q * top_x) < LONG:
        return q.astype(np.int64) @ x.astype(np.int64).T
    # the few long vectors apart, so that the others keep their arithmetic
    limit = EXACT if max(top_q, top_x) < LONG else LONG
    rows, columns = q_len * top_x >= EXACT, x_len * top_q >= EXACT
    out = np.empty((len(q), len(x)), np.int64)
    if rows.all() and columns.all():
        far = np.outer(q_len, x_len) >= LONG if limit == EXACT else np.ones(out.shape, bool)
        if limit == EXACT:
            with np.errstate(over="ignore"):
                out[:] = q.astype(np.int64) @ x.astype(np.int64).T
        low, high = -(2**63) + 1, 2**63 - 1
        whole_x = {}
        for i, j in zip(*np.nonzero(far), strict=True):
            b = whole_x.setdefault(j, [int(v) for v in x[j]])
            out[i, j] = min(high, max(low, sum(int(v) * w for v, w in zip(q[i], b, strict=True))))
        return out
    for r in (rows, ~rows):
        for c in (columns, ~columns):
            out[np.ix_(r, c)] = products(q[r], x[c], q_len[r], x_len[c])
    return out


def search_cell(q: np.ndarray, q_ids: np.ndarray, floor: np.ndarray, x: np.ndarray, x_ids: np.ndarray,
                basis: np.ndarray, lead: int, k: int) -> Best:
    """The k best candidates of each query within one cell, own rows left out; scores below a query's floor may be missing."""
    order = np.argsort(-(x**2).sum(axis=1), kind="stable")
    x, x_ids = x[order], x_ids[order]
    with np.errstate(over="ignore", invalid="ignore"):
        q_rot, x_rot = q @ basis, x @ basis
        rest = lambda m: np.sqrt(np.maximum((m[:, lead:] ** 2).sum(axis=1), 0))
        q_rest, x_rest, q_len, x_len = rest(q_rot), rest(x_rot), np.linalg.norm(q, axis=1), np.linalg.norm(x, axis=1)
    best = Best(len(q), k)
    slack = 1e-6
    for at in range(0, len(x), BLOCK):
        floor = np.maximum(floor, best.floors())
        part = slice(at, at + BLOCK)
        with np.errstate(over="ignore", invalid="ignore"):  # what is no number any more is no bound: not below any floor
            live = np.flatnonzero(~(q_len * x_len[at] * (1 + slack) + slack < floor))
            if not len(live):
                break
            bound = q_rot[live, :lead] @ x_rot[part, :lead].T
            bound += q_rest[live, None] * x_rest[None, part]
            scale = q_len[live, None] * x_len[None, part]
            useful = ~(bound + slack * (1 + scale) < floor[live, None])
        columns = np.flatnonzero(useful.any(axis=0))
        if not len(columns):
            continue
        columns = columns[np.argsort(x_ids[part][columns], kind="stable")]
        exact = products(q[live], x[part][columns], q_len[live], x_len[part][columns])
        ids = x_ids[part][columns]
        exact[~useful[:, columns] | (q_ids[live, None] == ids[None, :])] = NONE
        rows = Best(len(live), k)
        rows.score, rows.id = (m[live] for m in (best.score, best.id)) if len(live) < len(q) else (best.score, best.id)
        rows.add(exact, ids)
        if len(live) < len(q):
            width = rows.score.shape[1]
            score, own = np.full((len(q), width), NONE), np.zeros((len(q), width), dtype=np.int64)
            score[:, :best.score.shape[1]], own[:, :best.id.shape[1]] = best.score, best.id
            score[live], own[live] = rows.score, rows.id
            best.score, best.id = score, own
        else:
            best.score, best.id = rows.score, rows.id
    return best


def gram(vectors: DataFrame, width: int) -> np.ndarray:
    """X'X of all vectors: a width x width sum, built on the executors."""

    def part(batches):
        total = np.zeros((width, width))
        for b in batches:
            m = _matrix(b.column("v"), width)
            m = m / np.maximum(1, np.linalg.norm(m, axis=1, keepdims=True) / EXACT)  # any basis is right; this keeps its numbers finite
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(width), width)), pa.array(np.tile(np.arange(width), width)),
                                          pa.array(total.ravel())], names=["i", "j", "s"])

    out = np.zeros((width, width))
    for r in vectors.mapInArrow(part, "i bigint, j bigint, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        out[r["i"], r["j"]] = r["s"]
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` greatest inner products of every query with all other rows.

    ``vectors`` has id and v (see :func:`whole_vectors`); ``is_query`` is a condition on id. A row is not a candidate of queries with its own id.
    Vectors of different lengths are compared over their common components. Rows that repeat an id count once, with the
    smallest of their vectors. Fewer candidates than k give all of them; no vectors give no rows.
    """
    spark = vectors.sparkSession
    schema = "query_id bigint, vec_id bigint, score bigint"
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    rows = checkpoint(vectors.groupBy("id").agg(F.min("v").alias("v")).withColumn("length", length))
    width, n = rows.agg(F.max(F.size("v")), F.count("*")).first()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    squares, basis = np.linalg.eigh(gram(rows, width))
    basis = np.ascontiguousarray(basis[:, ::-1])
    energy = np.cumsum(np.maximum(squares[::-1], 0))
    lead = int(np.searchsorted(energy, 0.8 * energy[-1])) + 1 if energy[-1] > 0 else 1

    # bands of falling length: quantiles of the lengths, split further by id where many rows are equally long
    bands = max(1, -(-n // BAND_ROWS))
    cuts = sorted(set(rows.approxQuantile("length", [i / bands for i in range(1, bands)], 0.2 / bands))) if bands > 1 else []
    band = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: F.col("length") > c)) if cuts else F.lit(0)
    sizes = {r["band"]: (r["n"], r["top"]) for r in
             rows.groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.max("length").alias("top")).collect()}
    cells = [(b, s, float(top)) for b, (size, top) in sizes.items() for s in range(max(1, -(-size // BAND_ROWS)))]
    number = {(b, s): i for i, (b, s, _) in enumerate(cells)}
    parts = F.array(*[F.lit(max(1, -(-sizes.get(b, (0, 0))[0] // BAND_ROWS))) for b in range(len(cuts) + 1)])
    first = F.array(*[F.lit(number.get((b, 0), 0)) for b in range(len(cuts) + 1)])
    placed = rows.withColumn("__b", band)
    cell = F.element_at(first, F.col("__b") + 1) + F.pmod(F.xxhash64("id", F.lit(7)), F.element_at(parts, F.col("__b") + 1)).cast("int")
    candidates = placed.select("id", "v", cell.alias("cell"))

    queries = rows.where(is_query)
    m = queries.count()
    if not m:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    blocks = max(1, -(-m // QUERY_ROWS))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("id", F.lit(8)), F.lit(blocks)).cast("int"))

    seeds = rows.orderBy(F.desc("length"), "id").limit(SEEDS).select("id", "v").toArrow()  # SEEDS rows at most
    seed_ids, seed_vectors = seeds["id"].to_numpy(), _matrix(seeds["v"], width)

    def floors(batches):
        for b in (whole.slice(at, QUERY_ROWS) for whole in batches for at in range(0, whole.num_rows, QUERY_ROWS)):
            q, ids = _matrix(b.column("v"), width), b.column("id").to_numpy()
            found = search_cell(q, ids, np.full(len(q), -np.inf), seed_vectors, seed_ids, basis, lead, k)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), b.column("block"), b.column("length"),
                                              pa.array(found.floors())], names=["id", "v", "block", "length", "floor"])

    ready = checkpoint(queries.select("id", "v", "block", "length").mapInArrow(
        floors, "id bigint, v array<double>, block int, length double, floor double"))
    reach = F.array(*[F.struct(F.lit(i).alias("cell"), F.lit(top).alias("top")) for i, (_, _, top) in enumerate(cells)])
    able = F.filter(reach, lambda c: F.col("length") * c["top"] * (1 + 1e-6) + 1e-6 >= F.col("floor"))
    left = ready.withColumn("c", F.explode(able)).select(F.col("c.cell").alias("cell"), "block", "id", "v", "floor")
    left = checkpoint(left)
    wanted = left.groupBy("cell").agg(F.sort_array(F.collect_set("block")).alias("blocks"))  # cells times blocks of numbers
    right = (candidates.join(wanted, "cell").withColumn("block", F.explode("blocks"))
             .select("cell", "block", "id", "v"))

    def search(_, qs: pa.Table, xs: pa.Table) -> pa.Table:
        if not qs.num_rows or not xs.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        ids = qs["id"].to_numpy()
        best = search_cell(_matrix(qs["v"], width), ids, qs["floor"].to_numpy(), _matrix(xs["v"], width), xs["id"].to_numpy(), basis, lead, k)
        there = best.score != NONE
        owner = np.broadcast_to(ids[:, None], best.id.shape)
        return pa.table({"query_id": owner[there], "vec_id": best.id[there], "score": best.score[there]})

    found = left.groupBy("cell", "block").cogroup(right.groupBy("cell", "block")).applyInArrow(search, schema)
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
