"""Shards of nearly equal bytes by a k-d tree over metadata.

Each node of the tree is cut at the weighted median along the dimension in which it is widest, until
the leaves reach the target bytes. Dimensions are numbers on a common grid of 2 ** GRID steps
between their least and largest value in the whole table; a string counts by its rank among all
distinct ones.

A median is found without sorting: sums of bytes in 2 ** STEP bins per node, then again inside the
bin that holds the median, until that bin holds no more than the tolerance. Rows at one place of the
grid (a source may hold a third of them) go on by the text's checksum, so that copies stay together
where they can, and then by a hash of the row, so that a cut can also go through a large group. A
level of the tree costs a few sums over small rows; only bounded tables of bins reach the driver.

Defined results: a null text has no bytes, so size 1 and checksum 0; null, infinite or missing
dimension values lie at the grid's start; rows equal in all keys are cut apart only where the bytes
ask for it; ids may be numbers or text; repeated rows are rows of their own; an empty table gives an
empty table; other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.llm.tables import Kept, running_sum

GRID = 30
STEP = 10
#: Nodes whose cuts are sought at once; the driver gets a row for each of their bins.
MOST_NODES = 256
#: A cut may miss the median by this share of the node's bytes.
TOLERANCE = 1 / 2000


def ranked(kept: Kept, rows: DataFrame, column: str, into: str) -> DataFrame:
    """rows with the rank of the column's value among its distinct values, from 1; null has none.

    The distinct values are ranked by ranges, and joined back from files, so that a value that many
    rows share can be split there.
    """
    values = rows.select(F.col(column).alias("_distinct")).where("_distinct IS NOT NULL").distinct()
    ranks = kept.write(running_sum(kept, values, [], ["_distinct"], F.lit(1).cast("long"), into), "ranks")
    return rows.join(ranks, F.col(column) == F.col("_distinct"), "left").drop("_distinct")


def document_dimensions() -> dict[str, Column]:
    """The metadata of documents: source and language by rank, size and id."""
    return {
        "source": F.col("_source_rank").cast("double"),
        "lang": F.col("_lang_rank").cast("double"),
        "size": F.log2(F.col("size")),
        "doc_id": F.col("_id_place").cast("double"),
    }


@dataclass
class _Node:
    """A node and the search for its cut: the keys so far, and the bytes before them."""

    number: int
    first: int  # its shards
    shards: int
    total: int = 0
    dimension: int = 0
    fixed: list[int] = field(default_factory=list)  # whole keys that rows at the cut share
    prefix: int = 0
    shift: int = GRID - STEP
    before: int = 0
    done: bool = False
    bound: int = 0  # rows at the fixed keys go left if their next key is below

    @property
    def goal(self) -> float:
        return self.total * (self.shards // 2) / self.shards

    def descend(self, bins: dict[int, int], slack: float) -> None:
        """Go into the bin that holds the median, or cut beside it."""
        upto = self.before
        for b in range(1 << STEP):
            held = bins.get(b, 0)
            if held and upto + held >= self.goal:
                break
            upto += held
        base = self.prefix << STEP
        last = len(self.fixed) == 2 and self.shift == 0
        if held <= slack or last:
            nearer = upto + held - self.goal < self.goal - upto
            self.bound, self.done = (base + b + nearer) << self.shift, True
            return
        self.before, self.prefix = upto, base + b
        if self.shift:
            self.shift -= STEP
        else:
            self.fixed.append(self.prefix)
            self.prefix, self.shift = 0, GRID - STEP


def _inline(rows: DataFrame, names: list[str], values: list[list[int]]) -> DataFrame:
    """A small table of numbers for a join."""
    told = ", ".join("(" + ", ".join(f"{v}L" for v in row) + ")" for row in values)
    return rows.sparkSession.sql(f"SELECT * FROM VALUES {told} AS t({', '.join(names)})")


def _search(nodes: list[_Node]) -> tuple[list[str], list[list[int]]]:
    names = ["_n", "_dimension", "_depth", "_fixed0", "_fixed1", "_prefix", "_shift", "_bound"]
    told = []
    for n in nodes:
        fixed = [*n.fixed, 0, 0][:2]
        told.append([n.number, n.dimension, len(n.fixed), *fixed, n.prefix, n.shift, n.bound])
    return names, told


def _at_cut(dimensions: int) -> tuple[Column, Column]:
    """Whether a row shares the keys that its node's search has fixed, and its next key."""
    key0 = F.element_at(F.array(*[F.col(f"_x{i}") for i in range(dimensions)]), F.col("_dimension").cast("int") + 1)
    depth = F.col("_depth")
    shared = ((depth < 1) | (key0 == F.col("_fixed0"))) & ((depth < 2) | (F.col("_tie") == F.col("_fixed1")))
    return shared, F.when(depth == 0, key0).when(depth == 1, F.col("_tie")).otherwise(F.col("_salt"))


def _goes_left(dimensions: int) -> Column:
    key0 = F.element_at(F.array(*[F.col(f"_x{i}") for i in range(dimensions)]), F.col("_dimension").cast("int") + 1)
    depth, bound = F.col("_depth"), F.col("_bound")
    by_salt = (F.col("_tie") < F.col("_fixed1")) | ((F.col("_tie") == F.col("_fixed1")) & (F.col("_salt") < bound))
    by_tie = F.when(depth == 1, F.col("_tie") < bound).otherwise(by_salt)
    return F.when(depth == 0, key0 < bound).otherwise((key0 < F.col("_fixed0")) | ((key0 == F.col("_fixed0")) & by_tie))


def kd_shards(
    kept: Kept,
    rows: DataFrame,
    dimensions: dict[str, Column],
    shards: int | None = None,
    target_bytes: int | None = None,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """rows (with doc_id, size and text_crc32) with a column shard.

    Give the number of shards or the target bytes of one.
    """
    raw = [F.coalesce(F.nanvl(c.cast("double"), F.lit(None).cast("double")), F.lit(None)) for c in dimensions.values()]
    raw = [F.when(F.abs(c) < float("inf"), c) for c in raw]
    bounds = rows.agg(F.sum("size"), *[f(c) for c in raw for f in (F.min, F.max)]).first()
    total = int(bounds[0] or 0)
    if shards is None:
        shards = max(1, -(-total // target_bytes))
    keys = []
    for i, c in enumerate(raw):
        low, high = bounds[1 + 2 * i], bounds[2 + 2 * i]
        if low is None or high <= low:
            keys.append(F.lit(0).cast("long"))
        else:
            place = F.floor((c - low) / (high - low) * ((1 << GRID) - 1)).cast("long")
            keys.append(F.coalesce(place, F.lit(0).cast("long")))
    tie = F.shiftright(F.col("text_crc32"), 32 - GRID)
    # By row, so that a cut can also go through rows without an id; it is written with them.
    salt = F.xxhash64("doc_id", F.monotonically_increasing_id()).bitwiseAND((1 << GRID) - 1)
    now = rows.select("*", *[k.alias(f"_x{i}") for i, k in enumerate(keys)], tie.alias("_tie"), salt.alias("_salt"))
    now = kept.write(now.withColumn("_node", F.lit(0).cast("long")), "keys")
    open_nodes, leaves = [_Node(0, 0, shards)], {}
    if shards == 1 or not total:
        open_nodes, leaves = [], {0: 0}
    while open_nodes:
        _widest(now, open_nodes, len(keys))
        for start in range(0, len(open_nodes), MOST_NODES):
            _find_cuts(now, open_nodes[start : start + MOST_NODES], len(keys), tolerance)
        table = _inline(now, *_search(open_nodes))
        joined = now.join(F.broadcast(table), F.col("_node") == F.col("_n"), "left")
        side = F.when(_goes_left(len(keys)), F.lit(1)).otherwise(F.lit(2))
        moved = F.when(F.col("_n").isNull(), F.col("_node")).otherwise(F.col("_node") * 2 + side)
        now = kept.write(joined.withColumn("_node", moved).select(*now.columns), "keys")
        below = []
        for n in open_nodes:
            half = n.shards // 2
            for child in (_Node(2 * n.number + 1, n.first, half), _Node(2 * n.number + 2, n.first + half, n.shards - half)):
                if child.shards == 1:
                    leaves[child.number] = child.first
                else:
                    below.append(child)
        open_nodes = below
    table = _inline(now, ["_n", "_shard"], [[n, s] for n, s in leaves.items()])
    named = now.join(F.broadcast(table), F.col("_node") == F.col("_n"))
    return named.select(*rows.columns, F.col("_shard").cast("int").alias("shard"))


def _find_cuts(now: DataFrame, nodes: list[_Node], dimensions: int, tolerance: float) -> None:
    """Refine the bins of all these nodes at once until each has its cut."""
    shared, key = _at_cut(dimensions)
    while searching := [n for n in nodes if not n.done]:
        table = _inline(now, *_search(searching))
        held = now.join(F.broadcast(table), F.col("_node") == F.col("_n")).where(shared)
        held = held.withColumn("_key", key).where(F.expr(f"shiftright(_key, CAST(_shift AS int) + {STEP}) = _prefix"))
        place = F.expr(f"shiftright(_key, CAST(_shift AS int)) & {(1 << STEP) - 1}")
        bins: dict[int, dict[int, int]] = {n.number: {} for n in searching}
        for r in held.groupBy("_node", place.alias("_bin")).agg(F.sum("size").alias("_sum")).collect():
            bins[r._node][r._bin] = int(r._sum)
        for n in searching:
            n.descend(bins[n.number], tolerance * n.total)


def _widest(now: DataFrame, nodes: list[_Node], dimensions: int) -> None:
    """Each node's bytes, and the dimension in which it is widest; a node without rows needs no cut."""
    spans = [(F.max(f"_x{i}") - F.min(f"_x{i}")).alias(f"w{i}") for i in range(dimensions)]
    found = {r._node: r for r in now.groupBy("_node").agg(F.sum("size").alias("total"), *spans).collect()}
    for n in nodes:
        if n.number not in found:
            n.done = True
            continue
        n.total = int(found[n.number].total)
        n.dimension = max(range(dimensions), key=lambda i: (found[n.number][f"w{i}"], -i))


def sized(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, source, lang, size, text_crc32): UTF-8 bytes of the text plus one, and its checksum."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id", "source", "lang", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )


def sharded(docs: DataFrame, shards: int = 8, tolerance: float = TOLERANCE) -> DataFrame:
    """Rows (doc_id, size, text_crc32, law, shard, slot, grown_shard), one per document.

    slot counts the rows of a shard from 0, in the order of doc_id, size and checksum.
    """
    kept = Kept()
    rows = kept.write(sized(docs), "sizes")
    rows = ranked(kept, ranked(kept, rows, "source", "_source_rank"), "lang", "_lang_rank")
    numeric = isinstance(rows.schema["doc_id"].dataType, T.NumericType)
    rows = rows.withColumn("_id_place", F.col("doc_id")) if numeric else ranked(kept, rows, "doc_id", "_id_place")
    dealt = kd_shards(kept, rows, document_dimensions(), shards=shards, tolerance=tolerance)
    placed = running_sum(kept, dealt, ["shard"], ["doc_id", "size", "text_crc32"], F.lit(1).cast("long"), "slot")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("slot") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
