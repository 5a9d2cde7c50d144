"""Hard negatives by exact inner-product search in cover trees.

An anchor's positives are the rows of its own label with the largest inner products; its negatives for
a positive are the best rows of other labels whose product lies in a window below the positive's.

Vectors of one tree are lifted onto a sphere by one more component, sqrt(M^2 - |x|^2) with M the largest
norm, so that the nearest are those with the largest products. A cover tree is built over them: the
children of a node are a net of its members at half its radius, its own centre first, and each node
keeps its covering radius r, the largest distance from its centre c to a member. A query q (lifted with
0) has a product with every member within |q| r of its product with c, on both sides.

A search descends best first: of all open nodes the one with the highest upper bound, cut at the window,
comes next. Nodes that end below the window or below the worst of a full list of results, or that begin
above the window, are skipped, as are nodes whose labels can't count. Members of leaves are compared by
their exact integer products.

On Spark, rows are dealt by ranges of (label, nearest of PIVOTS sampled rows, row), so a label or a
vector that a third of the rows share is spread, and every TREE of them make a tree. Trees lie in groups
of about GROUP rows. Every group meets the anchors as a stream, its own trees in memory, and gives its
best for each; the best of all groups are ranked by a window, of which Spark keeps the first few rows
before the shuffle. The pivots only decide which rows share a tree, never a result.

Defined results: rows with a null label or vector, or with a null or non-finite component, take no part.
A shorter vector counts as filled up with zeros. Ties go by smaller id, a null id last, then by place
in the table. Rows with one id are rows of their own; a row is never its own positive. An anchor
without positives, or a positive without a row in its window, gives no rows; an empty table gives an
empty table. Ids and labels are integers. Products are exact; beyond a long they count as the largest
or smallest long. Other columns are not looked at.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from silverlode.llm.tables import Kept

#: Rows of a tree, members of a leaf, rows of a group, and sampled rows that order the others.
TREE, LEAF, GROUP, PIVOTS = 2048, 8, 1 << 16, 64
#: Share of the largest norm below which a distance may be rounding alone: the root of a double's precision, and more.
ROUNDING = 1e-6
_LAST = np.iinfo(np.int64).max


def _exact(vectors: np.ndarray) -> np.ndarray:
    """Whole numbers in a type whose inner products are exact: doubles, or Python's own."""
    largest = max(abs(int(vectors.max(initial=0))), abs(int(vectors.min(initial=0))))
    return vectors.astype(float if largest * largest * max(vectors.shape[1], 1) < 1 << 53 else object)


@dataclass
class Tree:
    """Rows and nodes of one cover tree. Node 0 is the root; children of a node lie side by side."""

    vectors: np.ndarray
    ids: np.ndarray  # with the largest long for a null
    rows: np.ndarray
    labels: np.ndarray
    centre: np.ndarray  # per node: place of a row
    radius: np.ndarray
    children: np.ndarray  # per node: first and behind the last child; none for a leaf
    members: np.ndarray  # per node: first and behind the last of its places in order
    order: np.ndarray
    low: np.ndarray  # per node: smallest and largest label
    high: np.ndarray

    def prepare(self) -> Tree:
        """Back from storage, for searches."""
        self.vectors = _exact(self.vectors)
        self.norm = float(np.sqrt(max((self.vectors.astype(float) ** 2).sum(1).max(initial=0), 0)))
        return self


def build(vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, leaf: int = LEAF) -> Tree:
    """The cover tree of at least one row."""
    numbers = vectors.astype(float)
    squares = (numbers**2).sum(1)
    lifted = np.column_stack([numbers, np.sqrt(squares.max() - squares)])
    # On a sphere the distance follows from the product.
    apart = np.sqrt(np.maximum(2 * (squares.max() - lifted @ lifted.T), 0))
    everyone = np.arange(len(rows))
    centre, radius, children, members, order = [0], [apart[0].max()], [], [], []
    tiny = ROUNDING * float(np.sqrt(squares.max()))
    waiting = [everyone]  # the members of every node, in the order of the nodes
    for node, own in enumerate(waiting):
        first = len(centre)
        if len(own) > leaf and radius[node] > tiny:
            rest, middle = own, centre[node]
            while len(rest):
                gap = apart[middle, rest]
                near = (gap <= radius[node] / 2) | (rest == middle)
                centre.append(middle)
                radius.append(gap[near].max())
                waiting.append(rest[near])
                rest = rest[~near]
                if len(rest):
                    middle = rest[0]
        else:
            members.append((node, own))
        children.append((first, len(centre)))
    # Members of a node are those of its leaves; only leaves list them.
    bounds = np.zeros((len(centre), 2), np.int64)
    for node, own in members:
        bounds[node] = (len(order), len(order) + len(own))
        order.extend(own.tolist())
    low = np.array([labels[own].min() for own in waiting])
    high = np.array([labels[own].max() for own in waiting])
    return Tree(
        vectors, ids, rows, labels, np.array(centre), np.array(radius), np.array(children), bounds, np.array(order), low, high
    )


class Best:
    """The k best of what has been seen in a window: by score, then id, then row."""

    def __init__(self, k: int, low: int | None = None, high: int | None = None):
        self.k, self.low, self.high = k, low, high
        self.found: list[tuple[int, int, int]] = []  # (-score, id, row), ascending

    def least(self) -> float:
        """A row below this score can't count any more."""
        bar = -np.inf if self.low is None else self.low
        return max(bar, -self.found[-1][0]) if len(self.found) == self.k else bar

    def most(self) -> float:
        return np.inf if self.high is None else self.high

    def take(self, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        right = (scores >= self.least()) & (scores <= self.most())
        if right.any():
            new = zip((-int(s) for s in scores[right]), ids[right].tolist(), rows[right].tolist(), strict=True)
            self.found = heapq.nsmallest(self.k, [*self.found, *new])


class Search:
    """One query's way through one tree; what it learns serves all of the query's windows."""

    def __init__(self, tree: Tree, query: np.ndarray, row: int, label: int, same: bool):
        self.tree, self.query, self.row, self.label, self.same = tree, query, row, label, same
        norm = float(np.sqrt((query.astype(float) ** 2).sum()))
        self.reach = tree.radius * norm
        self.slack = 1 + ROUNDING * norm * tree.norm
        self.opened: dict[int, tuple] = {}
        self.scored: dict[int, tuple] = {}

    def _possible(self, first: int, last: int) -> np.ndarray:
        low, high = self.tree.low[first:last], self.tree.high[first:last]
        if self.same:
            return (low <= self.label) & (high >= self.label)
        return (low != self.label) | (high != self.label)

    def _open(self, node: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Children that can count, with the bounds of their members' scores."""
        if node not in self.opened:
            first, last = self.tree.children[node] if node >= 0 else (0, 1)
            nodes = np.arange(first, last)[self._possible(first, last)]
            scores = (self.tree.vectors[self.tree.centre[nodes]] @ self.query).astype(float)
            reach = self.reach[nodes] + self.slack
            self.opened[node] = nodes, scores - reach, scores + reach
        return self.opened[node]

    def _members(self, node: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Exact scores, ids and rows of a leaf's members that count."""
        if node not in self.scored:
            tree = self.tree
            own = tree.order[slice(*tree.members[node])]
            alike = tree.labels[own] == self.label
            own = own[alike & (tree.rows[own] != self.row)] if self.same else own[~alike]
            self.scored[node] = tree.vectors[own] @ self.query, tree.ids[own], tree.rows[own]
        return self.scored[node]

    def run(self, best: Best) -> None:
        """Best-first descent for one window."""
        most, heap = best.most(), [(-np.inf, -1)]  # -1 stands above the root
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < best.least():
                break  # no open node can hold a better one
            if node >= 0 and self.tree.children[node][0] == self.tree.children[node][1]:
                best.take(*self._members(node))
                continue
            nodes, lower, upper = self._open(node)
            inside = (upper >= best.least()) & (lower <= most)
            for child, top in zip(nodes[inside].tolist(), np.minimum(upper[inside], most).tolist(), strict=True):
                heapq.heappush(heap, (-top, child))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows of a matrix, filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    at = np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[at] = flat
    return out


def _numbers(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(int(_LAST)).to_numpy(zero_copy_only=False)


def whole_vectors(rows: DataFrame, vector: str, factor: float) -> Column:
    """floor(factor * x) of every component; null where one is null or not finite, or the vector is null."""
    value = rows[vector]
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(value.isNotNull() & ~bad, F.transform(value, lambda x: F.floor(x.cast("double") * factor)))


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 10,
    lowest: int = 30,
    highest: int = 90,
) -> DataFrame:
    """rows: id, label and vector (whole numbers). anchors says which of them are queries.

    For each anchor and each of its best rows of the same label, the best rows of other labels whose
    score is from lowest to highest percent of the positive's.
    """
    kept, spark = Kept(), rows.sparkSession
    fit = rows.where("label IS NOT NULL AND vector IS NOT NULL")
    fit = fit.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), "vector", F.coalesce(anchors, F.lit(False)).alias("anchor"))
    fit = kept.write(fit.withColumn("row", F.monotonically_increasing_id()), "vectors")
    n, width = fit.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()

    groups = max(2 * spark.sparkContext.defaultParallelism, n // GROUP + 1)
    hashed = fit.select("vector", F.xxhash64("row").alias("h")).orderBy("h").limit(PIVOTS)
    pivots = [list(r.vector) for r in hashed.collect()]  # PIVOTS rows
    near = fit.mapInArrow(_nearest(pivots, width), f"{_KINDS}, cell int")
    dealt = near.repartitionByRange(groups, "label", "cell", "row").sortWithinPartitions("label", "cell", "row")
    trees = kept.write(dealt.select("id", "label", "vector", "row").mapInArrow(_plant(width, groups), "g int, tree binary"), "trees")

    queries = kept.write(fit.where("anchor").select("row", "id", "label", "vector"), "anchors")
    found = _searched(trees, queries.withColumn("windows", F.lit(None).cast(_WINDOWS)), groups, width, positives)
    told = ("positive", "positive_id", "positive_score")
    first = [F.col("found_score").desc(), F.col("found_id").asc_nulls_last(), "found"]
    found = found.withColumn("place", F.row_number().over(W.partitionBy("row").orderBy(*first))).where(F.col("place") <= positives)
    windows = found.select("row", *[F.col(f).alias(t) for f, t in zip(("found", "found_id", "found_score"), told, strict=True)])
    windows = kept.write(windows.groupBy("row").agg(F.collect_list(F.struct(*told)).alias("windows")), "windows")

    percents = (lowest, highest)
    found = _searched(trees, queries.join(windows, "row"), groups, width, negatives, percents)
    ranked = F.row_number().over(W.partitionBy("row", "positive").orderBy(*first))
    return found.withColumn("rank", ranked).where(F.col("rank") <= negatives).select(
        F.col("id").alias("anchor_id"),
        "positive_id",
        "rank",
        F.col("found_id").alias("negative_id"),
        "positive_score",
        F.col("found_score").alias("negative_score"),
    )


_KINDS = "id long, label long, vector array<long>, row long"
_WINDOWS = "array<struct<positive:long,positive_id:long,positive_score:long>>"
_FOUND = "row long, id long, positive long, positive_id long, positive_score long, found long, found_id long, found_score long"


def _nearest(pivots: list[list[int]], width: int):
    """Rows with the place of the pivot that is nearest by angle; zero vectors and ties take the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middles = np.array([p + [0] * (width - len(p)) for p in pivots], float).reshape(len(pivots), width)
        middles /= np.maximum(np.linalg.norm(middles, axis=1, keepdims=True), 1)
        for batch in batches:
            cells = np.argmax(_matrix(batch.column("vector"), width) @ middles.T, axis=1)
            columns = [batch.column(c) for c in ("id", "label", "vector", "row")]
            yield pa.record_batch([*columns, pa.array(cells, pa.int32())], names=["id", "label", "vector", "row", "cell"])

    return run


def _plant(width: int, groups: int):
    """Trees over the rows of a task, in their order; the task's number gives the trees' group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = TaskContext.get().partitionId() % groups
        for batch in batches:
            vectors = _matrix(batch.column("vector"), width)
            ids, rows, labels = (_numbers(batch.column(c)) for c in ("id", "row", "label"))
            cuts = np.linspace(0, len(rows), -(-len(rows) // TREE) + 1).astype(int)
            for a, z in pairwise(cuts.tolist()):
                tree = pickle.dumps(build(vectors[a:z], ids[a:z], rows[a:z], labels[a:z]))
                yield pa.record_batch([pa.array([group], pa.int32()), pa.array([tree], pa.binary())], names=["g", "tree"])

    return run


def _searched(
    trees: DataFrame, queries: DataFrame, groups: int, width: int, k: int, percents: tuple[int, int] | None = None
) -> DataFrame:
    """The k best of each group for every query, or for every window of it.

    Trees and queries meet in a partition sorted by group, the trees first; queries stream past them.
    """
    asked = queries.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("tree", F.lit(None).cast("binary"))
    both = asked.unionByName(trees, allowMissingColumns=True)
    dealt = both.repartition(groups, "g").sortWithinPartitions("g", F.col("tree").isNull())
    return dealt.select("g", "tree", "row", "id", "label", "vector", "windows").mapInArrow(_meet(width, k, percents), _FOUND)


def _meet(width: int, k: int, percents: tuple[int, int] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, trees = None, []
        for batch in batches:
            out: list[tuple] = []
            vectors = _matrix(batch.column("vector").fill_null([]), width)
            columns = (batch.column(c).to_pylist() for c in ("g", "row", "id", "label", "windows"))
            for i, (g, row, query_id, label, windows) in enumerate(zip(*columns, strict=True)):
                if g != group:
                    group, trees = g, []
                tree = batch.column("tree")[i]
                if tree.is_valid:
                    trees.append(pickle.loads(tree.as_py()).prepare())
                    continue
                for window, best in _asked(trees, vectors[i], row, label, windows, k, percents):
                    about = (row, query_id, window.get("positive"), window.get("positive_id"), window.get("positive_score"))
                    for score, found_id, found in best.found:
                        score = min(max(-score, -_LAST - 1), _LAST)
                        out.append((*about, found, None if found_id == _LAST else found_id, score))
            fields = [f.split(" ")[0] for f in _FOUND.split(", ")]
            lists = zip(*out, strict=True) if out else [[]] * len(fields)
            yield pa.record_batch([pa.array(list(x), pa.int64()) for x in lists], names=fields)

    return run


def _asked(
    trees: list[Tree], query: np.ndarray, row: int, label: int, windows: list[dict] | None, k: int, percents: tuple[int, int] | None
) -> list[tuple[dict, Best]]:
    """Each window of a query with its best; without percents one, open on both sides, for positives."""
    if percents is None:
        wanted = [({}, Best(k))]
    else:
        low, high = percents
        wanted = []
        for window in windows or []:
            score = window["positive_score"]
            best = Best(k, -(-low * score // 100), high * score // 100)
            if best.low <= best.high:
                wanted.append((window, best))
    for tree in trees:
        numbers = query.astype(tree.vectors.dtype)
        if tree.vectors.dtype != object:
            numbers = _exact(query[None, :])[0]
            if numbers.dtype == object:
                tree.vectors = tree.vectors.astype(np.int64).astype(object)
        search = Search(tree, numbers, row, label, percents is None)
        for _, best in wanted:
            search.run(best)
    return wanted
