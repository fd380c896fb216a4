"""Approximate nearest neighbours by inner product, over balanced posting lists.

Largest inner product is turned into smallest distance by one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm (0 for
queries). Lists come from a bounded sample: it is halved at the median along its widest direction until the leaves have the wanted size;
a leaf's mean is its centroid. Every vector of the table goes down the same halvings to its list, so lists stay balanced over all rows;
boundary vectors also go to other lists whose centroid is at most `CLOSURE` times as far as their own (up to `REPLICAS`). A query walks a
nearest-neighbour graph of the centroids, held in memory, and reads all lists whose centroid is at most `ratio` times as far as the nearest
one: their number isn't capped, since the walk goes on from every centroid within the ratio.

The ratio is fit, not set: for `ASKED` vectors of the sample it is the least one that reaches `RECALL` of their nearest neighbours within the
sample, of which as many count as lie as near as the nearest ones in the whole table. Vectors in clusters need few lists;
vectors spread evenly in many dimensions need most, as for any index of this kind.

Equal vectors are stored once, with their TOP + 1 smallest ids: more can't be among a query's nearest. Lists are dealt out in blocks of
`BLOCK` vectors and chunks of `CHUNK` queries, so a list that a third of all rows fall into is searched by many tasks. Vectors
stream past; only a block's vectors are held. Scores are inner products of the original vectors in double precision, added up pair
by pair, so they don't depend on blocks.

Edge cases: vectors that are null, zero, or hold null or non-finite components take no part, neither do rows with a null id or vectors whose
length isn't the most frequent one (the larger one on ties); a repeated id with equal vectors counts once, with different vectors
each counts; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from poiforge.llm.common import released, stored, table

TOP = 20
#: Vectors that the lists are fit on, at least and for each list, and bytes of them at most; vectors per list that are aimed at, lists at most.
SAMPLE, SAMPLE_LIST, SAMPLE_BYTES, LIST, MOST_LISTS = 20_000, 40, 256 << 20, 256, 16_384
REPLICAS, CLOSURE = 4, 1.1
#: Recall that the distance ratio is fit for, queries and vectors of the sample that it is fit on, and lists that are read at least.
RECALL, ASKED, AMONG, LEAST_LISTS = 0.98, 1_000, 40_000, 2
#: Neighbours of a centroid in the graph, centroids that a walk goes on from whatever the ratio, and how much farther than the ratio it goes.
DEGREE, BEAM, SLACK = 24, 128, 1.1
BLOCK, CHUNK = 4_096, 4_096
#: Hits that a search task holds before it merges those of a query from several lists.
HELD = 1_000_000


@dataclass
class Halvings:
    """A tree of median splits. Node i sends x to left[i] if x . way[i] <= at[i], else to right[i]; ~leaf numbers are leaves."""

    way: np.ndarray
    at: np.ndarray
    left: np.ndarray
    right: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, most: int) -> tuple[Halvings, list[np.ndarray]]:
        """(the tree, rows of each leaf). Leaves have at most so many rows, unless all their rows are equal."""
        ways, at, children, leaves = [], [], [], []

        def grow(rows: np.ndarray) -> int:
            if len(rows) > most:
                mean = x[rows].mean(0)
                c = x[rows] - mean
                v = np.ones(x.shape[1])
                for _ in range(8):  # power iteration
                    v = c.T @ (c @ v)
                    size = np.linalg.norm(v)
                    if size == 0:
                        break
                    v /= size
                along = x[rows] @ v
                bar = np.sort(along)[(len(rows) - 1) // 2]
                low = along <= bar
                if 0 < low.sum() < len(rows):
                    node = len(ways)
                    ways.append(v), at.append(bar), children.append([0, 0])
                    children[node] = [grow(rows[low]), grow(rows[~low])]
                    return node
            leaves.append(rows)
            return ~(len(leaves) - 1)

        grow(np.arange(len(x)))
        pairs = np.array(children, np.int64).reshape(-1, 2)
        return cls(np.array(ways).reshape(-1, x.shape[1]), np.array(at), pairs[:, 0], pairs[:, 1]), leaves

    def leaf(self, x: np.ndarray) -> np.ndarray:
        node = np.full(len(x), 0 if len(self.at) else -1)
        while len(go := np.flatnonzero(node >= 0)):
            n = node[go]
            low = (x[go] * self.way[n]).sum(1) <= self.at[n]
            node[go] = np.where(low, self.left[n], self.right[n])
        return ~node


@dataclass
class Index:
    """Centroids in the augmented space, the halvings that lead a vector to its list, and the graph that leads a query to the nearest centroids."""

    tree: Halvings
    centroids: np.ndarray
    largest: float
    #: Neighbours of all centroids end to end, and where each one's begin.
    graph: np.ndarray
    begin: np.ndarray
    ratio: float = 1.0

    @classmethod
    def fit(cls, sample: np.ndarray, largest: float, lists: int, among: int | None = None) -> Index:
        """among: vectors that will be searched (default: as many as the sample has)."""
        x = cls.augment(sample.astype(np.float64), largest)
        tree, leaves = Halvings.fit(x, max(1, -(-len(x) // max(1, lists))))
        centroids = np.array([x[r].mean(0) for r in leaves])
        n = len(centroids)
        # neighbours both ways, and a ring that keeps the graph connected
        pairs = [np.stack([np.arange(n), (np.arange(n) + 1) % n], 1)]
        near = min(DEGREE, n - 1)
        for lo in range(0, n, 1024):
            d = cls._distances(centroids[lo : lo + 1024], centroids)
            some = np.argpartition(d, near, axis=1)[:, : near + 1]
            pairs.append(np.stack([np.repeat(np.arange(lo, lo + len(d)), near + 1), some.ravel()], 1))
        pairs = np.concatenate(pairs)
        pairs = np.unique(np.concatenate([pairs, pairs[:, ::-1]]), axis=0)
        index = cls(tree, centroids, largest, pairs[:, 1].astype(np.int32), np.searchsorted(pairs[:, 0], np.arange(n + 1)))
        index._fit_ratio(x, among or len(x))
        return index

    @staticmethod
    def augment(x: np.ndarray, largest: float) -> np.ndarray:
        return np.concatenate([x, np.sqrt(np.maximum(largest**2 - (x**2).sum(1), 0))[:, None]], 1)

    @staticmethod
    def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum((a**2).sum(1)[:, None] - 2 * a @ b.T + (b**2).sum(1)[None], 0))

    def _fit_ratio(self, x: np.ndarray, among: int) -> None:
        """The least distance ratio that finds RECALL of the sample's own nearest neighbours: the TOP of them in `among` vectors correspond to fewer here."""
        step = max(1, len(x) // AMONG)
        x = x[::step]
        queries = x[:: max(1, len(x) // ASKED)].copy()
        queries[:, -1] = 0  # a query has no norm to fill up
        few = max(1, min(TOP, round(TOP * len(x) / among)))
        need = []
        for lo in range(0, len(queries), 100):
            some = queries[lo : lo + 100]
            score = some[:, :-1] @ x[:, :-1].T
            top = np.argpartition(-score, min(few, score.shape[1] - 1), axis=1)[:, : few + 1]  # the query itself is among them
            found = np.unique(top)
            lists, where = self.assign(x[found, :-1])
            far = self._distances(some, self.centroids)
            far /= np.maximum(far.min(1, keepdims=True), 1e-300)
            first = np.searchsorted(where, np.arange(len(found) + 1))
            own = (np.arange(lo, lo + len(some)) * max(1, len(x) // ASKED)).tolist()
            for q, me, ids in zip(far, own, top, strict=True):
                wanted = np.searchsorted(found, ids[ids != me][:few] if (ids == me).any() else ids[:few])
                need += [q[lists[first[w] : first[w + 1]]].min() for w in wanted.tolist()]
        self.ratio = float(np.quantile(need, RECALL)) * (1 + 1e-9) if need else 1.0

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(list, row) pairs by row: a vector's own list, and others whose centroid is at most CLOSURE times as far."""
        a = self.augment(x, self.largest)
        d = self._distances(a, self.centroids)
        rows, own = np.arange(len(a)), self.tree.leaf(a)
        bar = d[rows, own]
        d[rows, own] = -1  # comes first
        k = min(REPLICAS, d.shape[1])
        some = np.argpartition(d, k - 1, axis=1)[:, :k]
        fits = np.take_along_axis(d, some, 1) <= CLOSURE * bar[:, None]
        return some[fits], np.repeat(rows, fits.sum(1))

    def lists_for(self, query: np.ndarray) -> np.ndarray:
        """Search over the graph in waves, from all centroids among the BEAM nearest or within SLACK times the distance ratio, then pruning by the ratio."""
        q = np.append(query, 0.0)
        d = np.full(len(self.centroids), np.inf)
        walked = np.zeros(len(d), bool)
        fresh = np.unique(np.linspace(0, len(d) - 1, 16).astype(int))
        while len(fresh):
            d[fresh] = ((self.centroids[fresh] - q) ** 2).sum(1)
            beam = np.partition(d, BEAM - 1)[BEAM - 1] if len(d) > BEAM else np.inf
            go = ~walked & np.isfinite(d) & (d <= max(beam, (SLACK * self.ratio) ** 2 * d.min()))
            walked |= go
            some = np.flatnonzero(go)
            many = self.begin[some + 1] - self.begin[some]
            fresh = np.unique(self.graph[np.arange(int(many.sum())) + np.repeat(self.begin[some] - np.cumsum(many) + many, many)])
            fresh = fresh[np.isinf(d[fresh])]
        found = np.argsort(d, kind="stable")
        return found[(np.arange(len(d)) < LEAST_LISTS) & np.isfinite(d[found]) | (np.sqrt(d[found]) <= self.ratio * np.sqrt(d.min()))]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, dim)


def merged(query: np.ndarray, found: np.ndarray, score: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The `top` best hits of each query, a found id once with its best score; ties go to the smaller id."""
    order = np.lexsort((-score, found, query))
    query, found, score = query[order], found[order], score[order]
    first = np.ones(len(query), bool)
    first[1:] = (query[1:] != query[:-1]) | (found[1:] != found[:-1])
    query, found, score = query[first], found[first], score[first]
    order = np.lexsort((found, -score, query))
    query, found, score = query[order], found[order], score[order]
    keep = np.arange(len(query)) - np.searchsorted(query, query) < top
    return query[keep], found[keep], score[keep]


def valid(vectors: DataFrame, key: str, column: str) -> DataFrame:
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(column, lambda x: x != 0)
    return vectors.where(F.col(key).isNotNull() & F.col(column).isNotNull()).where(fine).select(F.col(key).cast("long").alias("id"), F.col(column).cast("array<float>" if "float" in dict(vectors.dtypes)[column] else "array<double>").alias("v"))


def nearest(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", every: int = 20, top: int = TOP) -> DataFrame:
    """query_id, rank, id, score: the `top` nearest found of every row whose id is divisible by `every`."""
    spark = vectors.sparkSession
    rows = valid(vectors, key, column)
    dims = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("m")).orderBy(F.desc("n"), F.desc("d")).first()
    if dims is None:
        return spark.createDataFrame([], f"query_id long, rank int, {key} long, score double")
    dim, largest = dims["d"], float(dims["m"]) ** 0.5
    rows = rows.where(F.size("v") == dim)
    few = Window.partitionBy("v").orderBy("id")
    ids = rows.distinct().withColumn("n", F.row_number().over(few)).where(F.col("n") <= top + 1)
    groups = stored(ids.groupBy("v").agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("ids")), "vectors")
    n = groups.count()
    lists_ = min(MOST_LISTS, -(-n // LIST))
    size = max(1, min(max(SAMPLE, SAMPLE_LIST * lists_), SAMPLE_BYTES // (4 * dim)))
    lists_ = min(lists_, -(-size // 8))
    part = min(1_000_000, 1_000_000 * size // max(1, n) + 1)
    taken = groups.where(F.pmod(F.xxhash64("rep"), F.lit(1_000_000)) < part).orderBy(F.xxhash64("rep")).select("v").limit(size).toArrow()
    sample = _matrix(taken["v"].combine_chunks(), dim) if taken.num_rows else _matrix(groups.select("v").limit(1).toArrow()["v"].combine_chunks(), dim)
    index = spark.sparkContext.broadcast(Index.fit(sample, largest, lists_, n))  # bounded by MOST_LISTS and SAMPLE_BYTES

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part_ = batch.slice(lo, 1024)
                lists, at = index.value.assign(_matrix(part_.column(0), dim))
                yield pa.RecordBatch.from_arrays([pa.array(lists.astype(np.int32)), *(c.take(pa.array(at)) for c in (part_.column(1), part_.column(2), part_.column(0)))], names=["list", "id", "ids", "v"])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [index.value.lists_for(q) for q in _matrix(batch.column(1), dim)]
            at = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(lists).astype(np.int32)), batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at))], names=["list", "id", "v"])

    kind = dict(groups.dtypes)["v"]
    stored_lists = stored(groups.select("v", "rep", "ids").mapInArrow(released(place), f"list int, id long, ids array<long>, v {kind}"), "lists")
    queries = rows.where(F.col("id") % every == 0).select("id", "v").distinct()
    asked = stored(queries.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(released(route), f"list int, id long, v {kind}"), "asked")

    def shares(df: DataFrame, size: int, name: str) -> DataFrame:
        return df.groupBy("list").agg(F.ceil(F.count("*") / size).alias(name))

    plan = stored(shares(stored_lists, BLOCK, "blocks").join(shares(asked, CHUNK, "chunks"), "list"), "plan")
    every_ = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    plan = F.broadcast(plan)  # at most MOST_LISTS rows
    left = stored_lists.join(plan, "list").select("list", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"), every_("chunks").alias("chunk"), F.lit(0).alias("kind"), "id", "ids", "v")
    right = asked.join(plan, "list").select("list", every_("blocks").alias("block"), F.pmod(F.xxhash64("id"), F.col("chunks")).alias("chunk"), F.lit(1).alias("kind"), "id", F.lit(None).cast("array<long>").alias("ids"), "v")
    both = left.unionByName(right).repartition("list", "block", "chunk").sortWithinPartitions("list", "block", "chunk", "kind", "id")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, block = None, [], None
        hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        n_hits = 0

        def rows_of(h: tuple) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(h[0], pa.int64()), pa.array(h[1], pa.int64()), pa.array(h[2], pa.float64())], names=["query_id", key, "score"])

        for batch in batches:
            keys = np.stack([np.asarray(batch.column(i)).astype(np.int64) for i in range(4)])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                if lo == hi:
                    continue
                group, is_query = tuple(keys[:3, lo]), keys[3, lo] == 1
                if group != now:
                    now, held, block = group, [], None
                part_ = batch.slice(lo, hi - lo)
                if not is_query:
                    held.append((np.asarray(part_.column(4)), part_.column(5), _matrix(part_.column(6), dim)))
                    continue
                if not held:
                    continue
                if block is None:
                    block = np.concatenate([h[0] for h in held]), [x for h in held for x in h[1].to_pylist()], np.concatenate([h[2] for h in held])
                rep, ids, x = block
                qid, q = np.asarray(part_.column(4)), _matrix(part_.column(6), dim)
                for at in range(0, len(qid), 256):
                    scores = q[at : at + 256] @ x.T
                    k = min(top + 1, scores.shape[1])
                    bar = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
                    out: list[tuple] = []
                    bar -= 1e-12 * (np.abs(bar) + largest**2)  # what a product of blocks may be off
                    hit, near = np.nonzero(scores >= bar[:, None])
                    exact = (q[at + hit] * x[near]).sum(1)  # the same for any block
                    cuts_ = np.searchsorted(hit, np.arange(len(scores) + 1)).tolist()
                    for i, (a, b) in enumerate(zip(cuts_, cuts_[1:], strict=False)):
                        me = int(qid[at + i])
                        some, s = near[a:b], exact[a:b]
                        order = np.lexsort((rep[some], -s))[: top + 1]
                        picked = [(-e, v) for e, j in zip(s[order].tolist(), some[order].tolist(), strict=True) for v in ids[j] if v != me]
                        out += [(me, v, -float(e)) for e, v in sorted(picked)[:top]]
                    if out:
                        a, b_, c = zip(*out, strict=True)
                        hits.append((np.array(a, np.int64), np.array(b_, np.int64), np.array(c, np.float64)))
                        n_hits += len(out)
                    if n_hits > HELD:
                        hits = [merged(*map(np.concatenate, zip(*hits, strict=True)), top)]
                        n_hits = len(hits[0][0])
                        if n_hits > HELD // 2:  # more queries than can be held: the rest is merged after the shuffle
                            yield rows_of(hits[0])
                            hits, n_hits = [], 0
        if hits:
            yield rows_of(merged(*map(np.concatenate, zip(*hits, strict=True)), top))

    hits = both.mapInArrow(released(search), f"query_id long, {key} long, score double").groupBy("query_id", key).agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), key)
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("query_id", "rank", key, "score")


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def brute_force(rows: list[tuple[int, list[float]]], every: int = 20, top: int = TOP) -> dict[int, list[tuple[int, float]]]:
    """All inner products, for tests and the recall."""
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float64)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = x @ x[i]
        s[i] = -np.inf
        order = np.lexsort((ids, -s))[: min(top, len(ids) - 1)]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out
