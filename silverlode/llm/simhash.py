"""Near-duplicates by SimHash, found with a Gray-order hierarchical index.

Fingerprints: a bit is 1 where it is 1 in over half of the shingles' hashes. Two fingerprints link
at no more than a given number of differing bits, and documents fall into the components.

The index is built group by group. Fingerprints that differ in at most d of 64 bits agree in one
of d + 1 blocks of bits, so each distinct fingerprint goes to d + 1 groups, one for each block's
value; a group with over MOST members is cut again by blocks of its other bits, as often as
needed, which ends because the free bits run out. So no group is large, whatever the corpus holds.
In a group, fingerprints are sorted by Gray rank, so that neighbours share many bits. Runs of FAN
make a node, runs of nodes a node above. A node holds the bits that all below it share and that
its parent doesn't hold. A search goes down level by level with the differences added up so far,
and leaves a node with all below it as soon as they are over the limit. A group yields no pairs
but a star for each of its components.

Defined results: a null or blank text has fingerprint zero, which links like any other; texts with
fewer words than a shingle are one shingle; every row gives one row, also rows with the same id;
a null id counts as no id when the smallest is sought; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.llm.arrow import bounded, flat_words
from silverlode.llm.tables import Kept, components

SEED = 42
MOST = 4096
FAN = 16
_FULL = (1 << 64) - 1
#: How many (query, node) pairs a search holds at a time.
_FRONT = 1 << 20

# ---------------------------------------------------------------- fingerprints


def shingle_hashes(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of all texts, and each text's bounds in them."""
    words, bounds = flat_words(texts)
    spaced = pc.binary_join_element_wise(words, pa.scalar("", words.type), pa.scalar(" ", words.type))
    data = (spaced.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
    at = np.frombuffer(spaced.buffers()[1], np.int64)[: len(words) + 1] if len(words) else np.zeros(1, np.int64)
    sizes = np.diff(bounds)
    counts = np.where(sizes == 0, 0, np.maximum(sizes - width + 1, 1))
    ends = np.concatenate(([0], np.cumsum(counts)))
    # The first word of each shingle, and the word after its last.
    first = np.arange(ends[-1]) + np.repeat(bounds[:-1] - ends[:-1], counts)
    after = np.minimum(first + width, np.repeat(bounds[1:], counts))
    digest = xxhash.xxh64_intdigest
    found = [digest(data[a:z], SEED) for a, z in zip(at[first].tolist(), (at[after] - 1).tolist(), strict=True)]
    return np.array(found, np.uint64), ends


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float32)


def majority(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each text the bits that are set in over half its hashes."""
    made = np.zeros(len(ends) - 1, np.uint64)
    for start in range(0, len(made), 512):
        stop = min(start + 512, len(made))
        own = hashes[ends[start] : ends[stop]]
        sizes = np.diff(ends[start : stop + 1])
        text = np.repeat(np.arange(stop - start), sizes) * 2048
        seen = np.zeros((stop - start) * 2048, np.int64)
        data = own.astype("<u8").view(np.uint8).reshape(-1, 8)
        for k in range(8):
            seen += np.bincount(text + k * 256 + data[:, k], minlength=len(seen))
        ones = seen.reshape(-1, 256).astype(np.float32) @ _BITS  # exact below 2 ** 24 shingles
        if len(own) >= 1 << 24:
            ones = seen.reshape(-1, 256) @ _BITS.astype(np.int64)
        bits = ones.reshape(stop - start, 64) * 2 > sizes[:, None]
        made[start:stop] = np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()
    return made


def fingerprints(docs: DataFrame, shingle: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, fp): fp is the fingerprint's 64 bits as a long."""
    rows = docs.select(docs[id_column].alias("doc_id"), docs[text_column].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in bounded(batches):
            made = majority(*shingle_hashes(part.column("text"), shingle))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(made.view(np.int64))], names=["doc_id", "fp"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


# ---------------------------------------------------------------- the index of one set of groups


def gray_rank(code: Column) -> Column:
    """Place of a 64-bit code in Gray order, as a long whose signed order is that order."""
    for step in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, step))
    return code.bitwiseXOR(F.lit(-(1 << 63)))


class _Level:
    """Nodes of one level: the leaves' codes or runs of FAN nodes below, never across groups."""

    def __init__(self, every: np.ndarray, some: np.ndarray, group: np.ndarray, last: np.ndarray):
        self.group, self.last = group, last  # last: the last leaf below
        self.every, self.some = every, some  # the AND and the OR of the codes below
        self.shared = every | ~some
        self.first_child = self.children = np.zeros(0, np.int64)
        self.held = self.shared  # the shared bits that the parent doesn't hold

    def above(self) -> _Level:
        starts = np.flatnonzero(np.concatenate(([True], self.group[1:] != self.group[:-1])))
        sizes = np.diff(np.concatenate((starts, [len(self.group)])))
        place = np.arange(len(self.group)) - np.repeat(starts, sizes)
        heads = np.flatnonzero(place % FAN == 0)
        counts = np.diff(np.concatenate((heads, [len(self.group)])))
        made = _Level(
            np.bitwise_and.reduceat(self.every, heads),
            np.bitwise_or.reduceat(self.some, heads),
            self.group[heads],
            self.last[heads + counts - 1],
        )
        made.first_child, made.children = heads, counts
        self.held = self.shared & ~np.repeat(made.shared, counts)
        return made


def linked(codes: np.ndarray, group: np.ndarray, distance: int) -> np.ndarray:
    """For each code the place of the first one of its component within its group.

    codes: uint64, sorted by group and then by Gray rank.
    """
    size = len(codes)
    levels = [_Level(codes, codes, group, np.arange(size))]
    while len(levels[-1].group) > 1 and (levels[-1].group[1:] == levels[-1].group[:-1]).any():
        levels.append(levels[-1].above())
    root_of = np.searchsorted(levels[-1].group, group)
    ends = np.searchsorted(group, group, "right")
    work = np.cumsum(ends - np.arange(size))  # what each query can meet at most
    parent = np.arange(size)
    start = 0
    while start < size:
        done = work[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(work, done + _FRONT, "right")))
        query = np.arange(start, stop)
        query = query[ends[query] - query > 1]
        node = root_of[query]
        differ = np.zeros(len(query), np.int64)  # a code has the bits that its own root holds
        for above, level in zip(levels[:0:-1], levels[-2::-1], strict=True):
            counts = above.children[node]
            query, differ = np.repeat(query, counts), np.repeat(differ, counts)
            offset = np.arange(len(query)) - np.repeat(np.cumsum(counts) - counts, counts)
            node = np.repeat(above.first_child[node], counts) + offset
            ahead = level.last[node] > query
            query, node, differ = query[ahead], node[ahead], differ[ahead]
            differ = differ + np.bitwise_count((codes[query] ^ level.every[node]) & level.held[node])
            near = differ <= distance
            query, node, differ = query[near], node[near], differ[near]
        _unite(parent, query, node)
        start = stop
    return parent


def _unite(parent: np.ndarray, one: np.ndarray, other: np.ndarray) -> None:
    """Merge the sets that the links join; parent holds for each place its set's first place."""
    while True:
        a, b = parent[one], parent[other]
        apart = a != b
        if not apart.any():
            return
        one, other = one[apart], other[apart]
        np.minimum.at(parent, np.maximum(a[apart], b[apart]), np.minimum(a[apart], b[apart]))
        while (parent[parent] != parent).any():
            parent[:] = parent[parent]


# ---------------------------------------------------------------- links of all fingerprints


def blocks(free: int, count: int) -> list[int]:
    """The free bits in count masks of nearly equal size, runs of neighbours."""
    bits = [1 << k for k in range(64) if free >> k & 1]
    cuts = [round(len(bits) * i / count) for i in range(count + 1)]
    return [sum(bits[a:z]) for a, z in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(codes: DataFrame, distance: int, most: int = MOST) -> DataFrame:
    """Links (a, b) between the distinct codes of column fp that join all codes within distance.

    A component of a group gives a star, so the links are no more than the groups' members.
    """
    kept = Kept()
    codes = codes.select("fp")
    found: DataFrame | None = None
    pending, masks = codes.withColumn("mask", F.lit(0).cast("long")), [0]
    while masks:
        finer = {_signed(m): [_signed(m | b) for b in blocks(_FULL & ~m, distance + 1) if b] for m in masks}
        finer = {m: f if bin(m & _FULL).count("1") < 64 else [] for m, f in finer.items()}
        choice = F.lit(None).cast("array<long>")
        for m, f in finer.items():
            choice = F.when(F.col("mask") == m, F.array(*[F.lit(x) for x in f]).cast("array<long>")).otherwise(choice)
        pending = pending.select("fp", F.explode(choice).alias("mask")).withColumn("part", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = pending.groupBy("mask", "part").count()
        hot = kept.write(sizes.where(F.col("count") > most).select("mask", "part"), "hot")
        masks = [r.mask & _FULL for r in hot.select("mask").distinct().collect()]  # d + 1 to a small power
        if masks:
            pending = kept.write(pending, "pending")
            made = _group_links(pending.join(hot, ["mask", "part"], "left_anti"), distance)
            pending = pending.join(hot, ["mask", "part"], "left_semi").select("fp", "mask")
        else:
            made = _group_links(pending, distance)
        made = kept.write(made, "links")
        found = made if found is None else found.unionByName(made)
    return found


def _group_links(rows: DataFrame, distance: int) -> DataFrame:
    """Links within the groups (mask, part), each of which has at most MOST rows."""
    dealt = rows.withColumn("gray", gray_rank(F.col("fp"))).repartition("mask", "part")
    dealt = dealt.sortWithinPartitions("mask", "part", "gray").select("mask", "part", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        waiting = 0
        for batch in batches:
            held.append(np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]))
            waiting += batch.num_rows
            if waiting >= 1 << 16:
                rows = np.concatenate(held, axis=1)
                last = np.flatnonzero((rows[:2, 1:] != rows[:2, :-1]).any(axis=0))
                if len(last):
                    yield _stars(rows[:, : last[-1] + 1], distance)
                    rows = rows[:, last[-1] + 1 :]
                held, waiting = [rows], rows.shape[1]
        if waiting:
            yield _stars(np.concatenate(held, axis=1), distance)

    return dealt.mapInArrow(run, "a long, b long")


def _stars(rows: np.ndarray, distance: int) -> pa.RecordBatch:
    new = np.concatenate(([True], (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)))
    group = np.cumsum(new) - 1
    several = np.bincount(group)[group] > 1
    codes, group = rows[2][several], group[several]
    if len(codes):
        parent = linked(codes.view(np.uint64), group, distance)
        codes, heads = codes[(leaf := parent != np.arange(len(parent)))], codes[parent[leaf]]
    else:
        heads = codes
    return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(heads)], names=["a", "b"])


# ---------------------------------------------------------------- documents


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    distance: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Rows (doc_id, fp, component_id): the smallest doc_id that links reach, the own one included."""
    kept = Kept()
    own = kept.write(fingerprints(docs, shingle, id_column, text_column), "fingerprints")
    codes = kept.write(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "codes")
    roots = kept.write(components(links(codes, distance)), "roots")
    joined = codes.join(roots, codes.fp == roots.node)
    smallest = kept.write(joined.groupBy("root").agg(F.min("least").alias("smallest")), "smallest")
    named = roots.join(smallest, "root").select("node", "smallest")
    names = codes.join(named, codes.fp == named.node, "left").select(
        F.col("fp").alias("code"), F.coalesce("smallest", "least").alias("component_id")
    )
    names = kept.write(names, "components")
    return own.join(names, own.fp == names.code).select("doc_id", "fp", "component_id")


def hex_digits(code: Column) -> Column:
    return F.lpad(F.lower(F.hex(code)), 16, "0")
