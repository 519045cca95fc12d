"""Approximate nearest neighbours by cosine, through low-dimensional stable
projections and kd-trees.

Vectors are scaled to length one, so nearest by cosine is nearest by distance,
and projected to ``DIMS`` dimensions by a fixed Gaussian matrix. Gaussian
projections are 2-stable: the squared projected distance of two vectors at
distance d is d^2 times a chi-square variable of ``DIMS`` degrees of freedom.
So a search visits points by projected distance, checks their true distance,
and may stop at projected distance t once ``chi2(t^2 / d_k^2) >= SURE``, d_k
being the k-th distance found so far: a point nearer than d_k would have been
met by now with that probability.

The index is a kd-tree over the projections in two levels. Its upper splits
are fitted on the projections of the ``SAMPLE`` vectors of least hash and cut
the space into at most ``MAX_CELLS`` cells; every vector lies in a cell, and a
cell is dealt by hash into blocks of about ``BLOCK`` vectors, each with a
kd-tree of its own in the task that holds it. A query first searches its own
cell, which bounds its k-th distance; then it goes to those other cells whose
bounding box doesn't pass the stopping test yet. Within a block its leaves are
visited in the order of their boxes' distance, under the same test. Queries of
a block stream past it, in chunks of ``QUERIES`` so that no task gets all.

The driver holds the splits and boxes (at most ``MAX_CELLS``) and the sample's
projections. Of equal vectors only the k + 1 of least id are candidates (no
more can be among a query's k nearest); they are picked by a per-group limit
before the shuffle, so a vector that holds a third of all rows costs a task
k + 1 rows.

Defined results: rows with a null id, and vectors that are null, empty, zero
or hold a null or non-finite component take no part. A shorter vector counts
as ending in zeros. Rows that repeat an id and its vector are one; an id with
several vectors asks a query for each, and is a candidate with each. A query
never finds its own id. Fewer candidates give fewer rows; an empty table gives
an empty result. Columns but the id and the vector are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import staged
from tessera.operators.topk import top_n_per_group

K = 5
EVERY = 50
#: Projected dimensions (even), and the probability at which a search stops.
DIMS, SURE = 8, 0.97
SEED = 7
SAMPLE, MAX_CELLS, BLOCK, LEAF, QUERIES = 1 << 16, 1024, 8192, 64, 1 << 16


def chi2_cdf(x: float, dims: int) -> float:
    """Chi-square distribution of an even number of degrees of freedom."""
    half, term, total = x / 2, 1.0, 1.0
    for i in range(1, dims // 2):
        term *= half / i
        total += term
    return 1 - math.exp(-half) * total


def chi2_bound(sure: float, dims: int) -> float:
    """The x at which ``chi2_cdf(x, dims)`` reaches ``sure``, by bisection."""
    lo, hi = 0.0, 1.0
    while chi2_cdf(hi, dims) < sure:
        hi *= 2
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, dims) < sure else (lo, mid)
    return hi


def matrix(vectors, dim: int) -> np.ndarray:
    """An Arrow list array as rows of doubles, short ones filled with zeros.
    Rows are scaled by powers of two, which changes no cosine."""
    values = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), float)
    size = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(size), dim))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)] = values
    _, exponent = np.frexp(np.abs(out).max(axis=1, initial=0))
    return np.ldexp(out, -exponent[:, None])


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with that of ``b``, summed in one order, so
    equal vectors have equal cosines."""
    return (a * b).sum(axis=-1) / np.sqrt((a * a).sum(axis=-1) * (b * b).sum(axis=-1))


def projection(dim: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dim, DIMS))


def mixed(ids: np.ndarray) -> np.ndarray:
    """Ids spread evenly over the numbers below 2^31."""
    return ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)


def split_order(points: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Leaves of a kd-tree: row numbers, cut at the median of the widest side
    until at most ``leaf`` are left."""
    out, stack = [], [np.arange(len(points))]
    while stack:
        rows = stack.pop()
        if len(rows) <= leaf:
            out.append(rows)
            continue
        side = int(np.ptp(points[rows], axis=0).argmax())
        half = np.argpartition(points[rows, side], len(rows) // 2)
        stack += [rows[half[len(rows) // 2:]], rows[half[:len(rows) // 2]]]
    return out


class Cells:
    """The upper kd-tree: splits of the projected space into cells."""

    def __init__(self, sample: np.ndarray, wanted: int):
        self.side, self.cut, self.left, self.right = [], [], [], []
        self.count = 0
        self.root = self._grow(sample, wanted)

    def _grow(self, points: np.ndarray, wanted: int) -> int:
        """A split's number, or -1 - c for cell c."""
        side = int(np.ptp(points, axis=0).argmax()) if len(points) else 0
        order = np.sort(points[:, side]) if len(points) else points
        cut = order[len(order) // 2] if len(order) else 0.0
        if wanted < 2 or not len(order) or order[0] == cut:
            self.count += 1
            return -self.count
        at = len(self.side)
        self.side.append(side)
        self.cut.append(float(cut))
        self.left.append(0)
        self.right.append(0)
        low = points[:, side] < cut
        self.left[at] = self._grow(points[low], wanted // 2)
        self.right[at] = self._grow(points[~low], wanted - wanted // 2)
        return at

    def of(self, points: np.ndarray) -> np.ndarray:
        at = np.full(len(points), self.root)
        side, cut, left, right = (np.array(x) for x in (self.side, self.cut, self.left, self.right))
        while len(rows := np.flatnonzero(at >= 0)):
            s = at[rows]
            at[rows] = np.where(points[rows, side[s]] < cut[s], left[s], right[s])
        return -1 - at


def box_gaps(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of each point to each box."""
    out = np.zeros((len(points), len(low)))
    for i in range(points.shape[1]):
        p = points[:, i:i + 1]
        out += np.maximum(0, np.maximum(low[:, i] - p, p - high[:, i])) ** 2
    return out


class Block:
    """The vectors of one block under a kd-tree of their projections."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, project: np.ndarray):
        points = unit(rows) @ project
        leaves = split_order(points, LEAF)
        order = np.concatenate(leaves)
        self.ids, self.rows, self.unit = ids[order], rows[order], unit(rows[order])
        self.edges = np.cumsum([0] + [len(x) for x in leaves])
        self.low = np.array([points[x].min(axis=0) for x in leaves])
        self.high = np.array([points[x].max(axis=0) for x in leaves])

    def search(self, ids: np.ndarray, rows: np.ndarray, project: np.ndarray, far: np.ndarray, k: int):
        """Places (query, candidate) of up to ``k`` nearest found of each
        query, with their cosines. ``far``: squared k-th distance known."""
        own = unit(rows)
        gaps = box_gaps(own @ project, self.low, self.high)
        order = np.argsort(gaps, axis=1)
        stop = chi2_bound(SURE, DIMS)
        pool = 2 * k + 2  # what rounding may put out of order is sorted out below
        near, place = np.full((len(ids), pool), -2.0), np.full((len(ids), pool), -1)
        live = np.arange(len(ids))
        for step in range(len(self.edges) - 1):
            leaf = order[live, step]
            reach = np.minimum(far[live], np.where(place[live, k - 1] >= 0, 2 - 2 * near[live, k - 1], np.inf))
            on = gaps[live, leaf] < stop * reach + 1e-12
            live, leaf = live[on], leaf[on]
            if not len(live):
                break
            by_leaf = np.argsort(leaf, kind="stable")
            for part in np.split(by_leaf, np.flatnonzero(np.diff(leaf[by_leaf])) + 1):
                q = live[part]
                a, b = self.edges[leaf[part[0]]], self.edges[leaf[part[0]] + 1]
                found = own[q] @ self.unit[a:b].T
                found[ids[q][:, None] == self.ids[a:b]] = -2.0
                both = np.hstack([near[q], found])
                where = np.hstack([place[q], np.broadcast_to(np.arange(a, b), found.shape)])
                where[both == -2.0] = -1
                best = np.argsort(-both, axis=1, kind="stable")[:, :pool]
                near[q], place[q] = np.take_along_axis(both, best, 1), np.take_along_axis(where, best, 1)
        q, rank = np.nonzero(place >= 0)
        c = place[q, rank]
        score = cosines(rows[q], self.rows[c])
        order = np.lexsort((self.ids[c], -score, q))
        q, c, score = q[order], c[order], score[order]
        first = np.arange(len(q)) - np.searchsorted(q, q) < k
        return q[first], c[first], score[first]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, embedding) of the rows that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    return rows.filter(F.col("vec_id").isNotNull() & F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0))


def _rows(batch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("vec_id").to_numpy(), matrix(batch.column("embedding"), dim)


def _mapped(df: DataFrame, each, schema: str) -> DataFrame:
    """``each`` over Arrow batches that have rows."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from each(batch)

    return df.mapInArrow(run, schema)


def fitted_cells(rows: DataFrame, dim: int, n: int) -> Cells:
    """The upper splits, from the ``SAMPLE`` rows of least hash."""
    import pyarrow as pa

    some = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(n, SAMPLE))
    project = projection(dim)

    def projected(batch):
        points = unit(_rows(batch, dim)[1]) @ project
        yield pa.RecordBatch.from_arrays([pa.array(list(points), pa.list_(pa.float64()))], ["p"])

    points = np.array([r.p for r in _mapped(some, projected, "p array<double>").collect()]).reshape(-1, DIMS)
    return Cells(points, min(MAX_CELLS, -(-n // BLOCK)))


def cell_boxes(rows: DataFrame, cells: Cells, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows per cell and the corners of its bounding box (at most
    ``MAX_CELLS`` rows reach the driver). An empty cell's box is nowhere."""
    import pyarrow as pa

    project = projection(dim)

    def boxed(batch):
        points = unit(_rows(batch, dim)[1]) @ project
        own = cells.of(points)
        order = np.argsort(own, kind="stable")
        start = np.flatnonzero(np.diff(own[order], prepend=-1))
        low, high = (f.reduceat(points[order], start) for f in (np.minimum, np.maximum))
        n = np.diff(np.append(start, len(own)))
        yield pa.RecordBatch.from_arrays([pa.array(own[order][start]), pa.array(n), *(pa.array(x) for x in [*low.T, *high.T])],
                                         ["cell", "n", *(f"{c}{i}" for c in ("low", "high") for i in range(DIMS))])

    names = [f"{c}{i}" for c in ("low", "high") for i in range(DIMS)]
    each = _mapped(rows, boxed, "cell long, n long, " + ", ".join(f"{x} double" for x in names))
    agg = [(F.min if x.startswith("low") else F.max)(x).alias(x) for x in names]
    size, low, high = np.zeros(cells.count, np.int64), np.full((cells.count, DIMS), np.inf), np.full((cells.count, DIMS), -np.inf)
    for r in each.groupBy("cell").agg(F.sum("n").alias("n"), *agg).collect():
        size[r.cell], low[r.cell], high[r.cell] = r.n, [r[x] for x in names[:DIMS]], [r[x] for x in names[DIMS:]]
    return size, low, high


_DEALT = "cell long, block long, chunk long, asks boolean, vec_id long, far double, embedding array<{}>"
_KEY = ["cell", "block", "chunk"]


def _search(batches, dim: int, k: int):
    """Rows sorted by block, candidates before queries: build the block's
    tree when the first query comes, then search batch by batch."""
    import pyarrow as pa

    project, key, held, block = projection(dim), None, [], None
    for batch in batches:
        keys = np.column_stack([batch.column(c).to_numpy() for c in _KEY])
        asks = batch.column("asks").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1) | (asks[1:] != asks[:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            if b <= a:
                continue
            part = batch.slice(a, b - a)
            if tuple(keys[a]) != key:
                key, held, block = tuple(keys[a]), [], None
            if not asks[a]:
                held.append(_rows(part, dim))
                continue
            if held:
                block, held = Block(np.concatenate([i for i, _ in held]), np.concatenate([r for _, r in held]), project), []
            if block is None:
                continue
            ids, rows = _rows(part, dim)
            far = part.column("far").to_numpy(zero_copy_only=False)
            q, c, score = block.search(ids, rows, project, far, k)
            yield pa.RecordBatch.from_arrays([pa.array(ids[q]), part.column("embedding").take(pa.array(q)), pa.array(block.ids[c]), pa.array(score)],
                                             ["query_id", "embedding", "vec_id", "score"])


def dealt(rows: DataFrame, asks: bool, dim: int, to, kind: str) -> DataFrame:
    """Rows sent to blocks: ``to(ids, rows, far)`` gives row numbers, cells,
    blocks and chunks."""
    import pyarrow as pa

    def send(batch):
        ids, own = _rows(batch, dim)
        far = batch.column("far").to_numpy(zero_copy_only=False)
        row, cell, block, chunk = to(ids, own, far)
        take = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell), pa.array(block), pa.array(chunk), pa.array(np.full(len(row), asks)), batch.column("vec_id").take(take),
             pa.array(far[row]), batch.column("embedding").take(take)], [*_KEY, "asks", "vec_id", "far", "embedding"])

    return _mapped(rows, send, _DEALT.format(kind))


def _spread(row: np.ndarray, cell: np.ndarray, blocks: np.ndarray):
    """Each (row, cell) once for every block of the cell."""
    n = blocks[cell]
    return np.repeat(row, n), np.repeat(cell, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row
    whose id is divisible by ``every``, by cosine, ties to the smaller id."""
    schema = "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors, id_col, vector_col).dropDuplicates(["embedding", "vec_id"])
    kind = rows.schema["embedding"].dataType.elementType.simpleString()
    rows = staged(rows, "vectors")
    few = staged(top_n_per_group(rows, ["embedding"], ["vec_id"], k + 1), "candidates")
    n, dim = few.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    queries = rows.filter(F.col("vec_id") % every == 0)
    n_queries = queries.count()
    if not n or not n_queries:
        return vectors.sparkSession.createDataFrame([], schema)
    cells, project = fitted_cells(few, dim, n), projection(dim)
    size, low, high = cell_boxes(few, cells, dim)
    blocks, chunks = -(-size // BLOCK), -(-n_queries // QUERIES)
    stop = chi2_bound(SURE, DIMS)

    def chunk_of(ids):
        return mixed(ids) % chunks

    def placed(ids, own, far):
        cell = cells.of(unit(own) @ project)
        row = np.repeat(np.arange(len(ids)), chunks)
        return row, cell[row], mixed(ids[row]) % blocks[cell[row]], np.tile(np.arange(chunks), len(ids))

    def home(ids, own, far):
        row, cell, block = _spread(np.arange(len(ids)), cells.of(unit(own) @ project), blocks)
        return row, cell, block, chunk_of(ids[row])

    def elsewhere(ids, own, far):
        points = unit(own) @ project
        gaps = box_gaps(points, low, high)
        gaps[np.arange(len(ids)), cells.of(points)] = np.inf
        row, cell, block = _spread(*np.nonzero(gaps < stop * far[:, None] + 1e-12), blocks)
        return row, cell, block, chunk_of(ids[row])

    def found(asked: DataFrame, to) -> DataFrame:
        here = dealt(few.withColumn("far", F.lit(0.0)), False, dim, placed, kind)
        both = here.unionByName(dealt(asked, True, dim, to, kind))
        both = both.repartition(*_KEY).sortWithinPartitions(*_KEY, "asks")
        return both.mapInArrow(lambda batches: _search(batches, dim, k), f"query_id long, embedding array<{kind}>, vec_id long, score double")

    def best(rows: DataFrame) -> DataFrame:
        return top_n_per_group(rows, ["query_id", "embedding"], [F.col("score").desc(), F.col("vec_id").asc()], k, rank_col="rank")

    unbounded = F.lit(float("inf"))
    first = staged(best(found(queries.withColumn("far", unbounded), home)), "nearest-home")
    reach = first.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), "embedding", (2 - 2 * F.col("score")).alias("far"))
    asked = queries.join(reach, ["vec_id", "embedding"], "left").select("vec_id", "embedding", F.coalesce("far", unbounded).alias("far"))
    rest = found(staged(asked, "reach"), elsewhere)
    out = best(first.drop("rank").unionByName(rest))
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
