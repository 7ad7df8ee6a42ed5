"""Exact top-k search by inner product with M-trees (operator 6).

Components x become whole numbers floor(1024 * x); the score of a query and
a candidate is their whole inner product.  To search it in a metric space,
every candidate gets one more coordinate, sqrt(M^2 - |x|^2) with M the
largest norm of its tree, and every query a 0 there: the Euclidean distance
d then satisfies d^2 = |q|^2 + M^2 - 2 * score, so the nearest are the best.

* *Index.*  Vectors are dealt to the nearest of at most ``PIVOTS`` pivots per
  dimension (rows with the smallest hashes of their ids), so a tree holds
  vectors that lie together; a cell of more than ``TREE_ROWS`` is split by a
  hash of the id.  A tree is bulk-loaded into pages: a leaf holds at most ``PAGE``
  vectors, an inner page at most ``FANOUT`` entries; an entry has a routing object,
  a covering radius and the distance to the routing object of its parent.
* *Home search.*  The queries of a tree are searched in it as it is built.  The
  score of the k-th best found is a floor for every other tree.
* *Search.*  The trees of a dimension are dealt to groves of at most ``GROVE_BYTES``;
  a query goes to every grove once, a tree to its grove once.  A grove's trees are
  held while its queries come by in blocks of at least ``QUERY_BLOCK``.  A block meets a
  tree at once: pages are opened best-first by the least d(q, routing) - radius,
  for those queries of the block for which that does not exceed the distance of the
  k-th best so far (at first the floor's); a tree whose covering radius cannot reach
  a query is not opened for it.  Before a distance is computed, the stored parent
  distance gives |d(q, parent) - d(o, parent)| as a lower bound; what it rules out
  for every query of the block is not computed.  Scores are whole numbers, and a bound
  must exceed the k-th distance by a rounding margin, so ties are resolved exactly.
* *Merge.*  At most k rows per query and grove are ranked; Spark limits them per
  query before the shuffle.

No pair of query and candidate or of query and tree is ever written; an executor's
task holds one grove and one block of queries, whatever the table's size.  Trees are
built in as many partitions as there are trees, up to ``MAX_TASKS``.

Defined results: rows with a null id, a null vector, or null or non-finite
components take no part; rows equal in id and vector count once; a query
has no candidate with its own id; only vectors of one length meet; an empty
vector scores 0; queries with fewer than k candidates return all of them; an
empty table gives no rows; other columns are not read.  Scores must fit a
64-bit integer.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, ship_package, small_side

SCALE = 1024
K = 10
QUERY_STEP = 100
TREE_ROWS = 4096
PAGE = 256
FANOUT = 16
QUERY_BLOCK = 1024
PIVOTS = 1024
MAX_TASKS = 20_000
GROVE_BYTES = 32 << 20  # of vectors at 4 bytes a component
GROVES = 64  # with more trees than that, so many at least
NONE = np.iinfo(np.int64).min  # no score


class Best:
    """The k best candidates so far of each query of a block (n x d); ``floors``:
    scores below them may be missing, ``NONE`` for no such score."""

    def __init__(self, own: np.ndarray, vectors: np.ndarray, floors: np.ndarray, k: int):
        n = len(own)
        self.own, self.vectors, self.k = own, vectors, k
        self.points = vectors.astype(np.float64)
        self.squares = (self.points ** 2).sum(axis=1)
        self.least = floors.astype(np.int64)  # of a candidate's score, and the id it must beat there
        self.least_id = np.full(n, np.iinfo(np.int64).max)
        self.ids, self.scores = np.zeros((n, k), np.int64), np.zeros((n, k), np.int64)
        self.count = np.zeros(n, np.int64)

    def offer(self, at: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Candidates ``ids`` with ``scores`` for the queries ``at``."""
        fine = ((scores > self.least[at]) | (scores == self.least[at]) & (ids < self.least_id[at])) & (ids != self.own[at])
        at, ids, scores = at[fine], ids[fine], scores[fine]
        if not len(at):
            return
        met = np.unique(at)
        held = np.arange(self.k) < self.count[met, None]
        at = np.concatenate([np.repeat(met, self.count[met]), at])
        ids, scores = np.concatenate([self.ids[met][held], ids]), np.concatenate([self.scores[met][held], scores])
        order = np.lexsort((ids, -scores, at))
        at, ids, scores = at[order], ids[order], scores[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        keep = rank < self.k
        at, rank = at[keep], rank[keep]
        self.ids[at, rank], self.scores[at, rank] = ids[keep], scores[keep]
        np.maximum.at(self.count, at, rank + 1)
        full = met[self.count[met] == self.k]
        self.least[full], self.least_id[full] = self.scores[full, -1], self.ids[full, -1]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """query ids, ids, scores: of each query best first, ties to smaller ids."""
        held = np.arange(self.k) < self.count[:, None]
        return np.repeat(self.own, self.count), self.ids[held], self.scores[held]


class MTree:
    """A bulk-loaded M-tree over whole vectors (n x d) with ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, page: int = PAGE, fanout: int = FANOUT,
                 seed: int = 7):
        n = len(ids)
        points = vectors.astype(np.float64)
        squares = (points ** 2).sum(axis=1)
        self.top = float(squares.max()) if n else 0.0
        lifted = np.hstack([points, np.sqrt(np.maximum(self.top - squares, 0.0))[:, None]])
        self.page, self.fanout = page, fanout
        self._rng = np.random.default_rng(seed)
        order: list[np.ndarray] = []
        # per page: routing object, radius, distance to the parent, children or rows
        self.routing: list[np.ndarray] = []
        self.radius: list[float] = []
        self.to_parent: list[float] = []
        self.children: list[list[int]] = []
        self.rows: list[tuple[int, int]] = []
        self.row_dist: list[np.ndarray] = []
        self._placed = 0
        if n:
            self._grow(lifted, np.arange(n), None, order)
        at = np.concatenate(order) if order else np.zeros(0, dtype=np.int64)
        self.ids, self.vectors = ids[at], _compact(vectors[at])
        # inner pages keep their children's routing objects, radii and parent distances together
        self.inner = {p: (np.stack([self.routing[c] for c in kids]), np.array([self.radius[c] for c in kids]),
                          np.array([self.to_parent[c] for c in kids]))
                      for p, kids in enumerate(self.children) if kids}
        self.first = self.routing[0] if n else None
        self.products = 0  # inner products computed so far
        del self.routing, self._rng

    def _grow(self, lifted, members, parent, order) -> int:
        mine = lifted[members]
        routing = mine[np.argmin(((mine - mine.mean(axis=0)) ** 2).sum(axis=1))]
        dist = np.sqrt(((mine - routing) ** 2).sum(axis=1))
        page = len(self.radius)
        self.routing.append(routing)
        self.radius.append(float(dist.max()))
        self.to_parent.append(0.0 if parent is None else float(np.sqrt(((routing - parent) ** 2).sum())))
        self.children.append([])
        self.rows.append((0, 0))
        self.row_dist.append(dist)
        if len(members) <= self.page:
            self.rows[page] = (self._placed, self._placed + len(members))
            self._placed += len(members)
            order.append(members)
            return page
        self.row_dist[page] = np.zeros(0)
        ways = min(self.fanout, -(-len(members) // self.page))
        pivots = mine[self._rng.choice(len(members), size=max(2, ways), replace=False)]
        gaps = ((mine ** 2).sum(axis=1)[:, None] + (pivots ** 2).sum(axis=1)[None, :] - 2 * mine @ pivots.T)
        near = gaps.argmin(axis=1)
        groups = [members[near == g] for g in range(len(pivots)) if (near == g).any()]
        if max(map(len, groups)) > 0.9 * len(members):  # many equal vectors: deal them evenly
            groups = np.array_split(members, max(2, ways))
        for g in groups:
            self.children[page].append(self._grow(lifted, g, routing, order))
        return page

    def search(self, query: np.ndarray, own, k: int, floor: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best candidates, best first, ties to smaller ids.
        With a ``floor`` those below that score may be missing."""
        best = Best(np.array([own]), query[None, :], np.array([NONE if floor is None else floor]), k)
        self.search_all(best, np.zeros(1, np.int64))
        return best.found()[1:]

    def search_all(self, best: Best, asked: np.ndarray) -> None:
        """Offers ``best`` the candidates that its queries ``asked`` may need."""
        if not len(self.ids) or not len(asked):
            return
        kind = _kind(self.top, float(best.squares[asked].max()))
        base = best.squares + self.top
        margin = 4e-6 * (1.0 + base ** 0.5)

        def far(at: np.ndarray) -> np.ndarray:
            least = best.least[at]
            reach = np.sqrt(np.maximum(0.0, base[at] - 2.0 * least)) + margin[at]
            return np.where(least == NONE, np.inf, reach)

        def gaps(routing: np.ndarray, at: np.ndarray) -> np.ndarray:  # the queries' last coordinate is 0
            apart = (routing ** 2).sum(axis=1)[:, None] + best.squares[at] - 2.0 * (routing[:, :-1] @ best.points[at].T)
            return np.sqrt(np.maximum(0.0, apart))

        start = gaps(self.first[None, :], asked)[0]
        queue = [(float((start - self.radius[0]).min()), 0, asked, start)]
        while queue:
            _, page, at, d = heapq.heappop(queue)
            reach = far(at)
            near = d - self.radius[page] <= reach
            if not near.all():
                at, d, reach = at[near], d[near], reach[near]
            if not len(at):
                continue
            if page in self.inner:
                routing, radius, to_parent = self.inner[page]
                may = np.abs(d - to_parent[:, None]) - radius[:, None] <= reach
                open_ = np.flatnonzero(may.any(axis=1))
                low = gaps(routing[open_], at) if len(open_) else []
                for c, gap in zip(open_.tolist(), low):
                    mine = may[c] & (gap - radius[c] <= reach)
                    if mine.any():
                        heapq.heappush(queue, (float((gap - radius[c])[mine].min()), self.children[page][c], at[mine], gap[mine]))
                continue
            a, b = self.rows[page]
            dist = self.row_dist[page]
            hit = a + np.flatnonzero((dist >= (d - reach).min()) & (dist <= (d + reach).max()))
            if not len(hit):
                continue
            self.products += len(hit) * len(at)
            value = best.vectors[at].astype(kind) @ self.vectors[hit].astype(kind).T
            least = best.least[at]
            if kind is not np.int64:  # rounded down, so that none is lost
                least = np.where(least == NONE, -np.inf, np.nextafter(least.astype(kind), kind(-np.inf))).astype(kind)
            q, row = np.divmod(np.flatnonzero(value >= least[:, None]), len(hit))
            best.offer(at[q], self.ids[hit[row]], value[q, row].astype(np.int64))


def _kind(a: float, b: float) -> type:
    """A type in which inner products of whole vectors with squared norms up to
    ``a`` and ``b``, and all sums on the way, are exact."""
    most = 1.001 * (a * b) ** 0.5
    return np.float32 if most < 2 ** 24 else np.float64 if most < 2 ** 53 else np.int64


def _compact(vectors: np.ndarray) -> np.ndarray:
    """The whole numbers in the smallest type that holds them."""
    for kind in (np.int16, np.int32):
        if not vectors.size or np.iinfo(kind).min <= vectors.min() and vectors.max() <= np.iinfo(kind).max:
            return vectors.astype(kind)
    return vectors


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def _cells(pivots: dict[int, np.ndarray]):
    """Adds the nearest pivot of each vector's dimension (columns: _id, _dim, _vector, _asked)."""
    def run(batches):
        for batch in batches:
            dims = batch.column(1).to_numpy()
            cell = np.zeros(batch.num_rows, np.int64)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                centres = pivots.get(dim)
                if dim and centres is not None and len(centres) > 1:
                    rows = _matrix(batch.column(2).take(pa.array(at)), dim).astype(np.float64)
                    cell[at] = ((centres ** 2).sum(axis=1)[None, :] - 2 * rows @ centres.T).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "_cell"])
    return run


def _found(best: Best) -> pa.Array:
    kind = pa.struct([(n, pa.int64()) for n in ("query_id", "vec_id", "score")])
    rows = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in best.found()], fields=list(kind))
    return pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)


def _build(page: int, fanout: int, k: int, query_block: int):
    """One row per tree: its grove, its pages, blocks of its own queries with the
    scores of their k-th best here, and what the queries find here."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        dim, number, groves = (x.as_py() for x in key)
        ids, vectors = table["_id"].to_numpy().astype(np.int64), _matrix(table["_vector"], dim)
        tree = MTree(ids, vectors, page, fanout)
        asked = np.flatnonzero(table["_asked"].to_numpy(zero_copy_only=False))
        best = Best(ids[asked], _compact(vectors[asked]), np.full(len(asked), NONE), k)
        for i in range(0, len(asked), query_block):
            tree.search_all(best, np.arange(i, min(i + query_block, len(asked))))
        blocks = [pickle.dumps((number, *(x[i:i + query_block] for x in (best.own, best.vectors, best.least))), protocol=5)
                  for i in range(0, len(asked), query_block)]
        return pa.table({"_dim": pa.array([dim], pa.int32()), "_tree": pa.array([number], pa.int64()),
                         "_groves": pa.array([groves], pa.int64()),
                         "_pages": pa.array([pickle.dumps(tree, protocol=5)], pa.binary()),
                         "_blocks": pa.array([blocks], pa.list_(pa.binary())), "_found": _found(best)})
    return run


def _search(k: int, query_block: int):
    """What the queries find in the trees of a grove other than their own (columns:
    _dim, _grove, _tree, _part; of each grove first its trees, then blocks with no _tree)."""
    def run(batches):
        grove, trees, held = None, [], []

        def found() -> pa.RecordBatch:
            home = np.concatenate([np.full(len(own), number) for number, own, *_ in held])
            best = Best(*(np.concatenate(x) for x in list(zip(*held))[1:]), k)
            for number, tree in trees:
                tree.search_all(best, np.flatnonzero(home != number))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in best.found()],
                                              names=["query_id", "vec_id", "score"])

        for batch in batches:
            for dim, number, tree, part in zip(*batch.columns):
                if (dim, number) != grove:
                    if held:
                        yield found()
                    grove, trees = (dim, number), []
                if tree.is_valid:
                    trees.append((tree.as_py(), pickle.loads(part.as_buffer())))
                    continue
                held.append(pickle.loads(part.as_buffer()))
                if sum(len(x[1]) for x in held) >= query_block:
                    yield found()
        if held:
            yield found()
    return run


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """_id, _dim, _vector (whole numbers) of the rows that take part."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    doubles = vectors.select(F.col("vec_id").cast("long").alias("_id"),
                             F.col("embedding").cast("array<double>").alias("_e"))
    return doubles.where(F.col("_id").isNotNull() & F.col("_e").isNotNull() & F.forall("_e", fine)).select(
        "_id", F.size("_e").alias("_dim"),
        F.transform("_e", lambda x: F.floor(x * scale).cast("long")).alias("_vector")).distinct()


def top_k(vectors: DataFrame, is_query: Column | None = None, k: int = K, scale: int = SCALE,
          tree_rows: int = TREE_ROWS, page: int = PAGE, fanout: int = FANOUT,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of every query.
    ``is_query`` is a condition on ``_id``; by default ids divisible by 100."""
    spark = vectors.sparkSession
    ship_package(spark)
    asked = F.col("_id") % QUERY_STEP == 0 if is_query is None else is_query
    whole = materialise(whole_vectors(vectors, scale).withColumn("_asked", F.coalesce(asked, F.lit(False))), "vectors")
    # dimensions without a query need no tree; one row per dimension
    dims = {r["_dim"]: min(PIVOTS, -(-r["n"] // tree_rows)) for r in whole.groupBy("_dim").agg(
        F.count(F.lit(1)).alias("n"), F.max("_asked").alias("any")).where("any").collect()}
    held = whole.where(F.col("_dim").isin(list(dims)))
    first = Window.partitionBy("_dim").orderBy(F.xxhash64("_id", F.lit(3)), "_id")
    most = max(dims.values(), default=0)
    # up to this number of rows Spark limits them in every task, before they move
    limit = "spark.sql.optimizer.windowGroupLimitThreshold"
    spark.conf.set(limit, str(max(PIVOTS, int(spark.conf.get(limit)))))
    pivots: dict[int, list] = {}
    for r in held.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= most).orderBy("_dim", "_n").collect():
        if len(pivots.setdefault(r["_dim"], [])) < dims[r["_dim"]]:
            pivots[r["_dim"]].append(r["_vector"])
    centres = {d: np.array(v, np.float64).reshape(len(v), d) for d, v in pivots.items()}
    celled = materialise(held.mapInArrow(
        _cells(centres), "_id long, _dim int, _vector array<long>, _asked boolean, _cell long"), "cells")
    sizes = materialise(celled.groupBy("_dim", "_cell").agg(
        F.ceil(F.count(F.lit(1)) / tree_rows).cast("long").alias("_ways")), "cell-sizes")
    # trees are numbered in each dimension, groves follow from their number and size
    upto, whole_dim = Window.partitionBy("_dim").orderBy("_cell"), Window.partitionBy("_dim")
    n_trees, full = F.sum("_ways").over(whole_dim), F.col("_dim").cast("long") * (4 * tree_rows)
    ways = small_side(materialise(sizes.select(
        "_dim", "_cell", "_ways", (F.sum("_ways").over(upto) - F.col("_ways")).alias("_first"),
        F.least(n_trees, F.greatest(F.lit(GROVES), F.ceil(
            n_trees / F.greatest(F.lit(1), F.floor(F.lit(GROVE_BYTES) / F.greatest(full, F.lit(1))))))).cast("long").alias("_groves")),
        "cell-trees"))
    dealt = celled.join(ways, ["_dim", "_cell"]).withColumn("_tree", F.col("_first") + F.pmod(F.xxhash64("_id"), F.col("_ways")))
    counted = ways.groupBy("_dim").agg(F.sum("_ways").alias("trees"), F.max("_groves").alias("groves"))
    parts, groves = (max(1, min(n or 0, MAX_TASKS)) for n in counted.agg(F.sum("trees"), F.sum("groves")).first())
    built = materialise(dealt.repartition(parts, "_dim", "_tree").groupBy("_dim", "_tree", "_groves").applyInArrow(
        _build(page, fanout, k, query_block),
        "_dim int, _tree long, _groves long, _pages binary, _blocks array<binary>, "
        "_found array<struct<query_id: long, vec_id: long, score: long>>"), "trees")
    home = built.select(F.explode("_found").alias("_f")).select("_f.*")
    trees = built.select("_dim", (F.col("_tree") % F.col("_groves")).alias("_grove"), "_tree", F.col("_pages").alias("_part"))
    blocks = built.select("_dim", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_groves") - 1)).alias("_grove"), "_blocks").select(
        "_dim", "_grove", F.lit(None).cast("long").alias("_tree"), F.explode("_blocks").alias("_part"))
    met = trees.unionByName(blocks).repartition(groves, "_dim", "_grove").sortWithinPartitions(
        "_dim", "_grove", F.col("_tree").asc_nulls_last())
    away = met.mapInArrow(_search(k, query_block), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return home.unionByName(away).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
