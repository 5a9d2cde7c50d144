"""Alignment of the tokens of two tokenizers over the bytes that both cover.

Each token is known by the byte offset at which it ends. Where both sides have an end, a group ends.
Most groups are one token against one, in long stretches in which the two end arrays are equal at a
fixed shift of the index. Such a stretch is skipped by exponential probing: blocks of 1, 2, 4, ...
ends are compared at the current shift, and the first block that differs is halved down to the place
where it does. There an irregular group begins; it is resolved by walking both arrays to their next
common end, which gives the new shift.

Tokens whose byte ranges overlap are linked. A pair of ids is counted in every document that holds it
linked, over the whole corpus, in two steps: a task counts the pairs of a chunk of documents (CHUNK
bytes of text, or one document), and the chunks' counts are summed by pair, so a pair that every
document holds arrives as one row per chunk. The counts go back to the chunks by a join on the pair;
no pair has more rows there than there are chunks.

Defined results: a text that is null or empty, or whose tokens do not spell it on one of the sides
(U+2581 in it, say), has no tokens: zeros, and an empty groups_sha256. Texts of any length are aligned
whole. Every row gives one row; repeated rows count as documents of their own. An empty table gives an
empty table. Other columns of docs are not looked at.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Callable, Iterator, Sequence
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.arrow import bounded
from silverlode.llm.tables import Kept

#: Bytes of text in a chunk, or one document.
CHUNK = 8 << 20
#: A pair of ids is one number, A's id times SECOND and B's.
SECOND = 1 << 32


class Alignment(NamedTuple):
    """Group g has A's tokens a_stops[g - 1] to a_stops[g] and B's alike; link k joins two places."""

    a_stops: np.ndarray
    b_stops: np.ndarray
    a_links: np.ndarray
    b_links: np.ndarray


def align(a_ends: list[int], b_ends: list[int]) -> Alignment:
    """Groups and links of two lists of ascending ends; the last ends are equal."""
    i, j, n = 0, 0, len(a_ends)
    stretches: list[int] = []  # first place on both sides and length, one after the other
    a_stops: list[int] = []  # of irregular groups
    b_stops: list[int] = []
    a_links: list[int] = []
    b_links: list[int] = []
    while i < n:
        a_end, b_end = a_ends[i], b_ends[j]
        if a_end == b_end:
            run = equal_run(a_ends, b_ends, i, j)
            stretches += (i, j, run)
            i += run
            j += run
            if i == n:
                break
            a_end, b_end = a_ends[i], b_ends[j]
        # Irregular: the side that ends first moves on, until both end at one offset.
        while True:
            a_links.append(i)
            b_links.append(j)
            if a_end < b_end:
                i += 1
                a_end = a_ends[i]
            elif b_end < a_end:
                j += 1
                b_end = b_ends[j]
            else:
                break
        i += 1
        j += 1
        a_stops.append(i)
        b_stops.append(j)
    first_a, first_b, size = np.array(stretches, np.int64).reshape(-1, 3).T
    step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    a, b = np.repeat(first_a, size) + step, np.repeat(first_b, size) + step
    return Alignment(
        np.sort(np.concatenate([a + 1, np.array(a_stops, np.int64)])),
        np.sort(np.concatenate([b + 1, np.array(b_stops, np.int64)])),
        np.concatenate([a, np.array(a_links, np.int64)]),
        np.concatenate([b, np.array(b_links, np.int64)]),
    )


def equal_run(a_ends: list[int], b_ends: list[int], i: int, j: int) -> int:
    """How many ends are equal one to one from i and j on, by doubling blocks, then halving one.

    The ends at i and j are equal.
    """
    run, block = 1, 1
    while True:
        a, b = i + run, j + run
        probe = a_ends[a : a + block]
        if not probe or probe != b_ends[b : b + block]:
            break
        run += len(probe)
        block *= 2
    while block > 1:  # the block differs, or there is less of it on one side: halve it
        block //= 2
        a, b = i + run, j + run
        probe = a_ends[a : a + block]
        if len(probe) == block and probe == b_ends[b : b + block]:
            run += block
    return run


class Side:
    """One tokenizer: ids of whole texts, and the bytes that each id stands for."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], spelled: list[bytes]):
        self.encode = encode
        self.spelled = pa.array(spelled, pa.large_binary())
        self.lengths = np.array([len(s) for s in spelled], np.int64)

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the texts' bounds in them."""
        found = self.encode(texts)
        bounds = np.concatenate(([0], np.cumsum([len(own) for own in found]))).astype(np.int64)
        return np.fromiter(chain.from_iterable(found), np.int64, int(bounds[-1])), bounds

    def spells(self, ids: np.ndarray, bounds: np.ndarray, wanted: list[bytes]) -> list[bool]:
        """Whether each text's tokens are its bytes."""
        at, data = _joined(self.spelled, ids, bounds)
        return [bytes(data[x:y]) == w for x, y, w in zip(at[:-1], at[1:], wanted, strict=True)]


def _joined(strings: pa.Array, places: np.ndarray, bounds: np.ndarray) -> tuple[list[int], memoryview]:
    """The strings at the places one after the other, and where in them each bound lies."""
    taken = strings.take(pa.array(places))
    ends = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1]
    return ends[bounds].tolist(), memoryview(taken.buffers()[2] or b"")


def byte_side(path: str) -> Side:
    """A byte-level vocabulary as ranks; special tokens in texts are plain text."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    model = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    spelled = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        spelled[rank] = token
    return Side(lambda texts: [model.encode_ordinary(f" {text}") for text in texts], spelled)


def piece_side(path: str) -> Side:
    """A sentencepiece model, which puts a blank before what it encodes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def bytes_of(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    return Side(lambda texts: model.encode(texts, num_threads=1), [bytes_of(i) for i in range(model.get_piece_size())])


@functools.cache
def _sides(byte_path: str, piece_path: str) -> tuple[Side, Side]:
    return byte_side(byte_path), piece_side(piece_path)


class Aligned(NamedTuple):
    """Texts of a chunk that have tokens: their places in it, and all their tokens, groups and links.

    Text k of these has the tokens a_bounds[k] to a_bounds[k + 1], and so on; stops and links count
    tokens of the chunk.
    """

    places: list[int]
    a_ids: np.ndarray
    b_ids: np.ndarray
    a_bounds: np.ndarray
    b_bounds: np.ndarray
    found: Alignment
    group_bounds: np.ndarray
    link_bounds: np.ndarray


def aligned_texts(texts: Sequence[str | None], a: Side, b: Side) -> Aligned:
    """The alignment of each text."""
    places = [k for k, text in enumerate(texts) if text]
    own = [texts[k] for k in places]
    wanted = [f" {text}".encode() for text in own]
    sides = [side.tokens(own) for side in (a, b)]
    good = [x and y for x, y in zip(a.spells(*sides[0], wanted), b.spells(*sides[1], wanted), strict=True)]
    del wanted
    if not all(good):
        keep = np.array(good, bool)
        sides = [_only(keep, *side) for side in sides]
        places = [p for p, right in zip(places, good, strict=True) if right]
    (a_ids, a_bounds), (b_ids, b_bounds) = sides
    lengths = a.lengths[a_ids], b.lengths[b_ids]
    parts = []
    for k in range(len(places)):
        first_a, first_b = int(a_bounds[k]), int(b_bounds[k])
        ends = (np.cumsum(x[bounds[k] : bounds[k + 1]]).tolist() for x, bounds in zip(lengths, (a_bounds, b_bounds), strict=True))
        one = align(*ends)
        parts.append(Alignment(one.a_stops + first_a, one.b_stops + first_b, one.a_links + first_a, one.b_links + first_b))
    found = Alignment(*[np.concatenate([np.empty(0, np.int64), *column]) for column in zip(*parts, strict=True)] or [np.empty(0, np.int64)] * 4)
    groups, links = (np.concatenate(([0], np.cumsum([len(p[c]) for p in parts]))).astype(np.int64) for c in (0, 2))
    return Aligned(places, a_ids, b_ids, a_bounds, b_bounds, found, groups, links)


def _only(keep: np.ndarray, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of the texts that stay."""
    sizes = np.diff(bounds)
    return ids[np.repeat(keep, sizes)], np.concatenate(([0], np.cumsum(sizes[keep])))


def groups_hashes(one: Aligned, a: Side, b: Side) -> list[str]:
    """SHA-256 of `a1,a2|b1;a3|b2,b3` for each text: the ids of each group in order.

    Every id stands with the sign behind it, and the last sign is left off. In a text the tokens of A
    in group g have g's earlier tokens of B before them, those of B also g's tokens of A.
    """
    n_a, n_b = len(a.lengths), len(b.lengths)
    signed = _signed_ids(n_a, n_b)
    a_stops, b_stops = one.found.a_stops, one.found.b_stops
    a_sizes, b_sizes = np.diff(a_stops, prepend=0), np.diff(b_stops, prepend=0)
    items = np.empty(len(one.a_ids) + len(one.b_ids), np.int64)
    a_signed, b_signed = one.a_ids.copy(), one.b_ids + 2 * n_a
    a_signed[a_stops - 1] += n_a
    b_signed[b_stops - 1] += n_b
    items[np.arange(len(one.a_ids)) + np.repeat(b_stops - b_sizes, a_sizes)] = a_signed
    items[np.arange(len(one.b_ids)) + np.repeat(a_stops, b_sizes)] = b_signed
    at, data = _joined(signed, items, one.a_bounds + one.b_bounds)
    return [hashlib.sha256(data[x : y - 1]).hexdigest() for x, y in zip(at[:-1], at[1:], strict=True)]


@functools.cache
def _signed_ids(n_a: int, n_b: int) -> pa.Array:
    """Ids of A with a comma, with a bar, ids of B with a comma, with a semicolon."""
    told = [f"{i}{sign}" for n, signs in ((n_a, ",|"), (n_b, ",;")) for sign in signs for i in range(n)]
    return pa.array(told, pa.large_string())


def alignments(
    docs: DataFrame, byte_path: str, piece_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id and groups: an array of structs (a, b), the ids of each group on the two sides."""
    rows = docs.select(docs[id_column].alias("doc_id"), docs[text_column].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in bounded(batches, most_bytes=CHUNK >> 2):
            groups: list[list] = [[] for _ in range(part.num_rows)]
            one = aligned_texts(part.column("text").to_pylist(), *_sides(byte_path, piece_path))
            a_cuts, b_cuts = ([0, *x.tolist()] for x in one.found[:2])
            for k, place in enumerate(one.places):
                for g in range(one.group_bounds[k], one.group_bounds[k + 1]):
                    ids = one.a_ids[a_cuts[g] : a_cuts[g + 1]], one.b_ids[b_cuts[g] : b_cuts[g + 1]]
                    groups[place].append({"a": ids[0].tolist(), "b": ids[1].tolist()})
            kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
            yield pa.record_batch([part.column("doc_id"), pa.array(groups, kind)], names=["doc_id", "groups"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, groups array<struct<a:array<int>,b:array<int>>>")


#: What a chunk's documents and the chunk itself have in the table between the two passes. places and
#: times are int32 arrays: the chunk's pairs that a document holds, and how many links of each.
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_PASS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, places binary, times binary, pairs array<long>, held array<int>"


def digests(
    docs: DataFrame, byte_path: str, piece_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per document its tokens, groups and links, and what the corpus says of its links.

    n_best counts links whose pair is the one most documents hold among the pairs of its A id, ties
    included; count_sum adds up over all links how many documents hold the pair.
    """
    kept = Kept()
    rows = docs.select(docs[id_column].alias("doc_id"), docs[text_column].alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    passed = kept.write(rows.mapInArrow(_first_pass(byte_path, piece_path), f"chunk long, doc_id {kind}, {_PASS}"), "aligned")

    chunks = passed.where("pairs IS NOT NULL")
    held = chunks.select("chunk", F.posexplode(F.arrays_zip("pairs", "held")).alias("place", "one"))
    held = held.select(F.col("chunk").alias("of"), "place", "one.pairs", "one.held")
    counts = kept.write(held.groupBy("pairs").agg(F.sum("held").alias("count")), "counts")
    first = F.shiftright("pairs", 32)  # SECOND is two to the 32
    most = counts.groupBy(first.alias("a")).agg(F.max("count").alias("most"))
    rated = counts.withColumn("a", first).join(most, "a")
    rated = rated.select("pairs", "count", (F.col("count") == F.col("most")).alias("best"))
    told = held.select("of", "place", "pairs").join(rated, "pairs").select("of", "place", "count", "best")

    own = passed.where("pairs IS NULL").select("chunk", "doc_id", *COUNTS, "groups_sha256", "places", "times")
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return own.groupBy("chunk").cogroup(told.groupBy("of")).applyInArrow(_second_pass, schema)


def _first_pass(byte_path: str, piece_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _sides(byte_path, piece_path)
        chunk = TaskContext.get().partitionId() << 32
        for part in bounded(batches, most_bytes=CHUNK):
            yield _chunk_rows(chunk, part.column("doc_id"), part.column("text").to_pylist(), a, b)
            chunk += 1

    return run


def _chunk_rows(chunk: int, doc_ids: pa.Array, texts: list[str | None], a: Side, b: Side) -> pa.RecordBatch:
    """A row for each document, and a last one with the chunk's pairs and in how many documents each is."""
    one = aligned_texts(texts, a, b)
    found, docs = one.found, len(one.places)
    linked = one.a_ids[found.a_links] * SECOND + one.b_ids[found.b_links]
    distinct, places = np.unique(linked, return_inverse=True)
    del linked
    # A document's pairs, each once with its number of links.
    which = np.repeat(np.arange(docs), np.diff(one.link_bounds))
    own, often = np.unique(which * max(len(distinct), 1) + places, return_counts=True)
    which, places = np.divmod(own, max(len(distinct), 1))
    held = np.bincount(places, minlength=len(distinct))
    ends = np.searchsorted(which, np.arange(1, docs))
    counts = [np.diff(x).tolist() for x in (one.a_bounds, one.b_bounds, one.group_bounds, one.link_bounds)]
    sizes, hashes, pairs, times = [(0, 0, 0, 0)] * len(texts), [""] * len(texts), [b""] * len(texts), [b""] * len(texts)
    split = (np.split(x.astype("<i4"), ends) if docs else [] for x in (places, often))
    for place, size, sha, p, t in zip(one.places, zip(*counts, strict=True), groups_hashes(one, a, b), *split, strict=True):
        sizes[place], hashes[place], pairs[place], times[place] = size, sha, p.tobytes(), t.tobytes()
    n = len(texts)
    columns = {
        "chunk": pa.array(np.full(n + 1, chunk, np.int64)),
        "doc_id": pa.concat_arrays([doc_ids, pa.nulls(1, doc_ids.type)]),
        **{name: pa.array([s[k] for s in sizes] + [None], pa.int64()) for k, name in enumerate(COUNTS)},
        "groups_sha256": pa.array([*hashes, None], pa.string()),
        "places": pa.array([*pairs, None], pa.binary()),
        "times": pa.array([*times, None], pa.binary()),
        "pairs": _last_list(n, distinct, pa.int64()),
        "held": _last_list(n, held, pa.int32()),
    }
    return pa.record_batch([*columns.values()], names=[*columns])


def _last_list(n: int, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """n nulls, then one list."""
    offsets = pa.array([None] * n + [0, len(values)], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(values, kind))


def _second_pass(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """The documents of one chunk with the counts of its pairs."""
    places = pairs["place"].to_numpy()
    counts, best = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
    counts[places] = pairs["count"].to_numpy()
    best[places] = pairs["best"].to_numpy()
    n_best, count_sum = [], []
    for own, times in zip(docs["places"], docs["times"], strict=True):
        at, often = (np.frombuffer(x.as_buffer(), "<i4") for x in (own, times))
        n_best.append(int(often @ best[at]))
        count_sum.append(int(often @ counts[at]))
    sums = [pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())]
    kept = [docs[c] for c in ("doc_id", *COUNTS)]
    return pa.table([*kept, *sums, docs["groups_sha256"]], names=["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256"])
