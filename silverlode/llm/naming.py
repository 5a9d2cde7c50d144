"""Exact duplicates by deterministic block naming.

A document's text, without its ASCII blanks, is cut into blocks of BLOCK bytes. Equal blocks get
the same integer name: blocks are dealt to tasks by content and sorted there, and a name counts
the distinct blocks in that order. Then adjacent names are paired, distinct pairs are named in the
same way, and so on until every document has one name. Documents are equal if and only if they
have as many blocks and the same last name; contents are compared, never only their hashes.

The texts cross the network once, and a block only once for each chunk of a task's input that holds
it, so a text with very many copies is folded together before the shuffle. Names return to the
documents by chunk and number, of which none is hot; only the final join on the last name can
meet a large group, on plain rows that an adaptive join can split.

Defined results: a null text is the empty text; all texts of blanks only are equal; rows that are
repeated are one group, of which one row stays (the first in the input as it was written down);
a null id comes after all others; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.arrow import bounded, raw
from silverlode.llm.tables import Kept

BLOCK = 8 << 10
#: Bytes of text whose blocks a task folds together at a time.
CHUNK = 24 << 20
BLANKS = b" \t\n\x0b\x0c\r"

_DOCS = "place long, chars long, text_sha256 string, names array<int>"
_BLOCKS = "local int, block binary"


def _cut(batches: Iterator[pa.RecordBatch], carry: list[str], block: int) -> Iterator[pa.RecordBatch]:
    """Two kinds of rows: documents with local block numbers, and each chunk's distinct blocks."""
    task = TaskContext.get().partitionId()
    chunk, held, local = 0, 0, {}
    place = 0
    for part in bounded(batches):
        texts = raw(part.column("text"))
        clean = [t.translate(None, BLANKS) for t in texts.to_pylist()]
        names = []
        new: list[bytes] = []
        for text in clean:
            pieces = [text[i : i + block] for i in range(0, len(text), block)] or [b""]
            own = []
            for piece in pieces:
                number = local.get(piece)
                if number is None:
                    number = local[piece] = len(local)
                    new.append(piece)
                own.append(number)
            names.append(own)
        size, fresh = part.num_rows, len(new)
        key = (task << 32) | chunk
        chars = pc.fill_null(pc.utf8_length(part.column("text")), 0).cast(pa.int64())
        columns = {c: pa.concat_arrays([part.column(c), pa.nulls(fresh, part.column(c).type)]) for c in carry}
        columns |= {
            "chunk": pa.array(np.full(size + fresh, key)),
            "place": _padded(pa.array(np.arange(place, place + size)), fresh),
            "chars": _padded(chars, fresh),
            "text_sha256": _padded(pa.array([hashlib.sha256(t).hexdigest() for t in clean], pa.string()), fresh),
            "names": _padded(pa.array(names, pa.list_(pa.int32())), fresh),
            "local": _padded(pa.array(np.arange(len(local) - fresh, len(local), dtype=np.int32)), size, before=True),
            "block": _padded(pa.array(new, pa.binary()), size, before=True),
        }
        yield pa.RecordBatch.from_pydict(columns)
        place += size
        held += sum(map(len, new))
        if held >= CHUNK:
            chunk, held, local = chunk + 1, 0, {}


def _padded(column: pa.Array, nulls: int, before: bool = False) -> pa.Array:
    empty = pa.nulls(nulls, column.type)
    return pa.concat_arrays([empty, column] if before else [column, empty])


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names for a task's blocks, which come in sorted order."""
    name, last = (TaskContext.get().partitionId() << 40) - 1, None
    for batch in batches:
        if not batch.num_rows:
            continue
        block = batch.column("block")
        new = np.ones(batch.num_rows, bool)
        new[0] = last is None or block[0].as_py() != last
        if batch.num_rows > 1:
            new[1:] = pc.not_equal(block[1:], block[:-1]).to_numpy(zero_copy_only=False)
        names = name + np.cumsum(new)
        name, last = int(names[-1]), block[-1].as_py()
        yield pa.RecordBatch.from_arrays([batch.column("chunk"), batch.column("local"), pa.array(names)], names=["chunk", "local", "name"])


def identities(kept: Kept, docs: DataFrame, carry: list[str], block: int = BLOCK) -> DataFrame:
    """Rows (carried columns, chunk, place, chars, text_sha256, blocks, name), one for each document.

    docs has a column text besides the carried ones. (chunk, place) tells rows apart;
    (blocks, name) is the text's identity.
    """
    rows = docs.select(*carry, "text")
    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carry)
    cut = Kept()
    both = cut.write(rows.mapInArrow(lambda b: _cut(b, carry, block), f"{fields}, chunk long, {_DOCS}, {_BLOCKS}"), "blocks")
    sorted_blocks = both.where("block IS NOT NULL").select("chunk", "local", "block").repartition("block").sortWithinPartitions("block")
    names = kept.write(sorted_blocks.mapInArrow(_number, "chunk long, local int, name long"), "names")
    own = kept.write(
        both.where("place IS NOT NULL").select(*carry, "chunk", "place", "chars", "text_sha256", "names"), "documents"
    )
    cut.drop()
    single = own.select("chunk", "place", F.size("names").alias("blocks"), F.posexplode("names").alias("pos", "local"))
    now = kept.write(single.join(names, ["chunk", "local"]).select("chunk", "place", "blocks", "pos", "name"), "level")
    done = now.where("blocks = 1").select("chunk", "place", "blocks", "name")
    most = now.agg(F.max("blocks")).first()[0] or 1
    width = 1
    while width < most:
        # Documents of over width blocks go on; their names now stand for width blocks each.
        pairs = now.where(F.col("blocks") > width).groupBy("chunk", "place", "blocks", F.shiftright("pos", 1).alias("pos"))
        pairs = pairs.agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"),
        )
        pairs = kept.write(pairs, "pairs")
        distinct = pairs.select("a", "b").distinct().repartition("a", "b").sortWithinPartitions("a", "b")
        named = kept.write(distinct.withColumn("name", F.monotonically_increasing_id()), "names")
        now = kept.write(pairs.join(named, ["a", "b"]).select("chunk", "place", "blocks", "pos", "name"), "level")
        width *= 2
        done = done.unionByName(now.where(F.col("blocks") <= width).select("chunk", "place", "blocks", "name"))
    return own.drop("names").join(done, ["chunk", "place"])


def duplicates(kept: Kept, docs: DataFrame, carry: list[str], id_column: str = "doc_id") -> DataFrame:
    """The carried columns with keep_id, group_size, kept and text_sha256, one row per document.

    Of equal texts the row with the most code points stays, then that with the smallest id.
    """
    rows = kept.write(identities(kept, docs, carry), "identities")
    first = F.min(F.struct(-F.col("chars"), F.col(id_column).isNull(), F.col(id_column).alias("id"), "chunk", "place"))
    groups = rows.groupBy("blocks", "name").agg(first.alias("first"), F.count(F.lit(1)).alias("group_size"))
    groups = groups.select(
        "blocks", "name", "group_size", F.col("first.id").alias("keep_id"), F.col("first.chunk").alias("_c"), F.col("first.place").alias("_p")
    )
    # Read from files it is dealt anew for the join, and then the rows of a hot text can be split there.
    groups = kept.write(groups, "groups")
    kept_row = (F.col("chunk") == F.col("_c")) & (F.col("place") == F.col("_p"))
    return rows.join(groups, ["blocks", "name"]).select(*carry, "keep_id", "group_size", kept_row.alias("kept"), "text_sha256")


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, keep_id, group_size, kept, text_sha256), one per row of docs, dropped ones too."""
    rows = docs.select(docs[id_column].alias("doc_id"), docs[text_column].alias("text"))
    return duplicates(Kept(), rows, ["doc_id"])
