"""Token ids in binary files: a shared zstandard dictionary, one frame per document, an offset index.

A data set is a folder with one dictionary and many files. A file holds, little-endian:

    head      8 bytes MAGIC, 32 bytes SHA-256 of the dictionary, u32 bytes per id (2 or 4),
              u32 place of the file's task, u32 place of the file among the task's
    frames    one zstandard frame per document, compressed with the dictionary
    index     an Arrow IPC stream: doc_id, frame (offset of the frame), first (ids of the file's
              documents before this one), and a last row with the two ends
    tail      u64 offset of the index, 8 bytes MAGIC, a line feed

A document is read by its frame alone: tail, index, one frame. A file that was written with another
dictionary is refused by its hash. Files and documents are in ascending order of doc_id, nulls first.

Spark writes the files: a row is a whole file of bounded size, and the text writer puts each row into
a file of its own on any file system Spark can reach, through its commit protocol, so that a task that
ran twice leaves one set of files. They are read back as binary files.

The dictionary is trained on a bounded sample: SAMPLES documents drawn evenly from all by a hash of
their row, and of each at most SAMPLE_IDS ids. It changes the size of the files, never what they hold.
With too few ids to train on, the sampled ids themselves are the dictionary.

Defined results: a null text is the empty text, and an empty text has the end id alone; texts of any
length are whole, in one frame; repeated rows and rows with equal or null ids are documents of their
own, in the order of the table; an empty table gives a data set without documents. Other columns of
docs are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
import os
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.llm.arrow import bounded, flat_words
from silverlode.llm.runs import RunStore
from silverlode.llm.tables import Kept, keyed, running_sum

MAGIC = b"SLTOKEN1"
HEAD = struct.Struct("<8s32sIII")
TAIL = struct.Struct("<Q8sc")
#: Sampled documents, ids of each, and bytes of the dictionary.
SAMPLES, SAMPLE_IDS, DICTIONARY_BYTES = 4096, 2048, 64 << 10
#: A file is closed when its frames take so many bytes; it has one document at least.
FILE_BYTES = 16 << 20
#: Bytes of text that a worker encodes at a time, or one document.
SLICE = 4 << 20
#: Bytes of text that a task writes, about.
TASK_BYTES = 64 << 20
LEVEL = 3
#: Words that are encoded as one text, and runs that are encoded at a time.
TOGETHER, BATCH = 256, 16_384


def n_words(run: str) -> int:
    """1 for a run of European letters, 2 with one sign behind it, 0 for runs that need a closer look."""
    signed = run[-1] in ".,;:!?"
    core = run[:-1] if signed else run
    plain = core.isalpha() and (core.isascii() or max(core) < "\u0250")
    return (1 + signed) * plain


class Encoder:
    """Ids of texts under a vocabulary file of the tokenizers library whose words end at blanks."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.size = tokenizer.get_vocab_size(with_added_tokens=True)

        # The tokens that end a word, and texts of some hundred words, which cost less than words one by one.
        suffix = tokenizer.model.end_of_word_suffix or ""
        ends = np.array([(tokenizer.id_to_token(i) or "").endswith(suffix) for i in range(self.size)])

        def encoded(texts: list[str]) -> list[np.ndarray]:
            return [np.array(e.ids, np.int32) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        def words(runs: list[str], counts: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            """Runs of known numbers of words, encoded as texts of some hundred; word ends tell them apart."""
            cuts = range(0, len(runs), TOGETHER)
            for start, ids in zip(cuts, encoded([" ".join(runs[i : i + TOGETHER]) for i in cuts]), strict=True):
                stops = np.flatnonzero(ends[ids]) + 1
                expected = np.cumsum(counts[start : start + TOGETHER])
                if len(stops) == expected[-1]:
                    yield ids, np.diff(stops[expected - 1], prepend=0)
                else:
                    yield one_by_one(runs[start : start + TOGETHER])

        def one_by_one(runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
            found = encoded(runs)
            return np.concatenate(found), np.array([len(ids) for ids in found])

        def encode(runs: list[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
            for start in range(0, len(runs), BATCH):
                part = runs[start : start + BATCH]
                counts = [n_words(run) for run in part]
                if other := [run for run, n in zip(part, counts, strict=True) if not n]:
                    yield other, *one_by_one(other)
                if several := [run for run, n in zip(part, counts, strict=True) if n]:
                    ids, sizes = zip(*words(several, [n for n in counts if n]), strict=True)
                    yield several, np.concatenate(ids), np.concatenate(sizes)

        if not tokenizer.model.end_of_word_suffix:
            raise ValueError("a vocabulary with word ends is needed")
        self.store = RunStore(encode)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the texts' bounds in them.

        Neither normalisation nor words of such a vocabulary reach across ASCII blanks, so a text's
        ids are those of the runs between them.
        """
        runs, bounds = flat_words(texts, lower=False)
        runs = runs.dictionary_encode()
        places = self.store.places(runs.dictionary.to_numpy(zero_copy_only=False).tolist())
        at = places[runs.indices.to_numpy(zero_copy_only=False)]
        return self.store.joined(at, bounds)


@functools.cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def id_bytes(largest: int) -> int:
    """Bytes that an id takes in a file."""
    return 2 if largest < 1 << 16 else 4


def trained(samples: Iterable[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary for serialized ids; the samples themselves where there are too few to train on."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes() if len(samples) > 7 else b"".join(samples)[:size]
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


class Writer:
    """Documents to files of about file_bytes."""

    def __init__(self, dictionary: bytes, width: int, part: int, file_bytes: int = FILE_BYTES):
        self.hash = hashlib.sha256(dictionary).digest()
        self.packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary))
        self.width, self.part, self.file_bytes, self.number = width, part, file_bytes, 0
        self._open()

    def _open(self) -> None:
        self.frames: list[bytes] = []
        self.doc_ids: list[pa.Scalar] = []
        self.offsets, self.firsts = [HEAD.size], [0]

    def add(self, doc_id: pa.Scalar, ids: np.ndarray) -> bytes | None:
        """Take one document; the whole file, if this fills it."""
        frame = self.packer.compress(ids.astype(f"<u{self.width}").tobytes())
        self.frames.append(frame)
        self.doc_ids.append(doc_id)
        self.offsets.append(self.offsets[-1] + len(frame))
        self.firsts.append(self.firsts[-1] + len(ids))
        return self.close() if self.offsets[-1] >= self.file_bytes else None

    def close(self) -> bytes | None:
        """The file with what has been taken since the last one; None for nothing."""
        if not self.frames:
            return None
        kind = self.doc_ids[0].type
        index = pa.record_batch(
            [
                pa.array([d.as_py() for d in self.doc_ids] + [None], kind),
                pa.array(self.offsets, pa.int64()),
                pa.array(self.firsts, pa.int64()),
            ],
            names=["doc_id", "frame", "first"],
        )
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, index.schema) as stream:
            stream.write_batch(index)
        head = HEAD.pack(MAGIC, self.hash, self.width, self.part, self.number)
        file = b"".join([head, *self.frames, sink.getvalue().to_pybytes(), TAIL.pack(self.offsets[-1], MAGIC, b"\n")])
        self.number += 1
        self._open()
        return file


class Reader:
    """One file: the ids of any of its documents, without unpacking the others."""

    def __init__(self, file: bytes | memoryview, dictionary: bytes):
        self.file = memoryview(file)
        magic, made_with, self.width, self.part, self.number = HEAD.unpack_from(self.file)
        index, again, _ = TAIL.unpack_from(self.file, len(self.file) - TAIL.size)
        if magic != MAGIC or again != MAGIC:
            raise ValueError("this is no file of token ids, or not all of one")
        if made_with != hashlib.sha256(dictionary).digest():
            raise ValueError("the file was written with another dictionary")
        self.unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        table = pa.ipc.open_stream(pa.py_buffer(self.file[index : len(self.file) - TAIL.size])).read_all()
        self.doc_ids = table["doc_id"].combine_chunks()[:-1]
        self.offsets = table["frame"].to_numpy()
        self.firsts = table["first"].to_numpy()

    def __len__(self) -> int:
        return len(self.doc_ids)

    def ids(self, k: int) -> np.ndarray:
        """Ids of the file's k-th document."""
        frame = self.file[self.offsets[k] : self.offsets[k + 1]]
        return np.frombuffer(self.unpacker.decompress(frame), f"<u{self.width}")

    def find(self, doc_id) -> list[int]:
        """Places of the documents with this id, which lie side by side; by halving."""

        def first(after: bool) -> int:
            low, high = 0, len(self)
            while low < high:
                middle = (low + high) // 2
                here = self.doc_ids[middle].as_py()
                if here is None or here < doc_id or (after and here == doc_id):
                    low = middle + 1
                else:
                    high = middle
            return low

        return [*range(first(False), first(True))]


def write(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    file_bytes: int = FILE_BYTES,
    samples: int = SAMPLES,
) -> None:
    """Encode all docs into files under path, in ascending order of their ids.

    vocabulary: path of the vocabulary file, at the same place on every executor. end_id follows the
    ids of each document. Rows are dealt by ranges of (id, row), so a repeated id is spread too.
    """
    spark, kept = docs.sparkSession, Kept()
    rows, key = keyed(kept, docs)
    rows = rows.select(rows[id_column].alias("doc_id"), rows[text_column].alias("text"), *[rows[k].alias(f"_k{i}") for i, k in enumerate(key)])
    keys = [f"_k{i}" for i in range(len(key))]
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    width = id_bytes(max(end_id, _encoder(vocabulary).size - 1))

    place = F.pmod(F.xxhash64(*keys), F.lit(max(n, 1)))
    sampled = rows.where(place < samples).select("text").mapInArrow(_sampler(vocabulary, end_id, width), "ids binary")
    dictionary = trained(r.ids for r in sampled.collect())  # samples pieces of SAMPLE_IDS ids, about
    _write_files(spark.createDataFrame([(bytearray(dictionary + b"\n"),)], "file binary").coalesce(1), f"{path}/dictionary")

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // TASK_BYTES + 1)
    dealt = rows.repartitionByRange(parts, "doc_id", *keys).sortWithinPartitions("doc_id", *keys)
    files = dealt.select("doc_id", "text").mapInArrow(_filer(vocabulary, end_id, dictionary, width, file_bytes), "file binary")
    _write_files(files, f"{path}/files")
    kept.drop()


def _sampler(vocabulary: str, end_id: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in bounded(batches, most_bytes=SLICE):
            ids, bounds = _encoder(vocabulary).ids(part.column("text"))
            # Of a long document the middle, where no text begins or ends alike.
            starts = np.maximum(bounds[:-1], (bounds[:-1] + bounds[1:] - SAMPLE_IDS) // 2)
            pieces = [np.append(ids[a : min(z, a + SAMPLE_IDS)], end_id) for a, z in zip(starts, bounds[1:], strict=True)]
            yield pa.record_batch([pa.array([p.astype(f"<u{width}").tobytes() for p in pieces], pa.binary())], names=["ids"])

    return run


def _filer(vocabulary: str, end_id: int, dictionary: bytes, width: int, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = Writer(dictionary, width, TaskContext.get().partitionId(), file_bytes)
        for part in bounded(batches, most_bytes=SLICE):
            ids, bounds = _encoder(vocabulary).ids(part.column("text"))
            for doc_id, a, z in zip(part.column("doc_id"), bounds[:-1], bounds[1:], strict=True):
                if file := writer.add(doc_id, np.append(ids[a:z], end_id)):
                    yield _one(file)
        if file := writer.close():
            yield _one(file)

    return run


def _one(file: bytes) -> pa.RecordBatch:
    return pa.record_batch([pa.array([file], pa.binary())], names=["file"])


def _write_files(files: DataFrame, path: str) -> None:
    """Each row as one file. A row ends with a line feed, which the writer puts there again."""
    value = F.expr("CAST(substring(file, 1, octet_length(file) - 1) AS STRING)")
    files.select(value.alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).where("length > 0").select("content")


def read_dictionary(spark: SparkSession, path: str) -> bytes:
    """The data set's dictionary."""
    found = _files(spark, f"{path}/dictionary").first()
    return bytes(found.content)[:-1] if found else b""


def read_digests(spark: SparkSession, path: str, kind: str = "long") -> DataFrame:
    """From the files of a data set: doc_id, start, n_tokens and ids_crc32 of every document.

    start is the number of ids of all documents before this one, in all files. kind is the type of
    the ids of documents.
    """
    dictionary, kept = read_dictionary(spark, path), Kept()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                file = Reader(content.as_buffer(), dictionary)
                crcs = [zlib.crc32(file.ids(k).astype("<u4").tobytes()) for k in range(len(file))]
                place = [pa.array(np.full(len(file), x), pa.int32()) for x in (file.part, file.number)]
                sizes = [pa.array(x, pa.int64()) for x in (file.firsts[:-1], np.diff(file.firsts), crcs)]
                yield pa.record_batch([*place, file.doc_ids, *sizes], names=["part", "number", "doc_id", "first", "n_tokens", "ids_crc32"])

    schema = f"part int, number int, doc_id {kind}, first long, n_tokens long, ids_crc32 long"
    read = kept.write(_files(spark, f"{path}/files").mapInArrow(run, schema), "read")
    files = read.groupBy("part", "number").agg(F.sum("n_tokens").alias("size"))
    files = running_sum(kept, files, [], ["part", "number"], F.col("size"), "upto")
    files = files.select("part", "number", (F.col("upto") - F.col("size")).alias("before"))
    found = read.join(files, ["part", "number"])
    return found.select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def digests(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Write docs to scratch files and read them back: see read_digests."""
    from silverlode.session import scratch_path

    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write(docs, path, vocabulary, end_id)
    return read_digests(spark, path, docs.schema["doc_id"].dataType.simpleString())
