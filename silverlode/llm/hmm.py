"""A hidden Markov language model, trained with Baum-Welch and scored with the forward recursion.

A hidden state emits a word by a share of its own for each word, whatever the vocabulary's size; the end
of a text is a word too. Shares are never gathered in one place: words are dealt to parts, and each
part holds the counts of its own words.

Unknown words: absolute discounting. Every word gives up part of a count, which goes to one more
word, that of the words not seen in training; a state gives it as much as its own words give up. The
probabilities of all words and of the unknown one add up to 1 in each state.

Jobs. (1) Texts are turned to word numbers, chunk by chunk, with a list of each chunk's distinct
words and their counts. (2) The counts are summed by word, and each word gets a place in its part; for
each chunk and part there is a list of places. (3) In a Baum-Welch round the parts send each chunk its
words' shares, and the chunk sends expected counts back, which the parts add up; start, moves and sums by
state come to the driver. (4) A last pass scores. Nothing that grows with the corpus is sent to the
driver or to all tasks.

Every round runs over all training documents, from a start that depends on the words' shares only.
Rounds end when the log likelihood of a token gains less than SETTLED. In training a document of over
LONGEST tokens is counted in stretches; scores always run over the whole.

Defined results: a null text is empty and has one token, its end; texts of any length are scored
whole; a null id counts as an empty one for the split; repeated rows are documents of their own;
without any training document all words are unknown; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from silverlode.llm.arrow import Sequences, bounded, filled, flat_words
from silverlode.llm.tables import Kept

STATES = 8
#: Parts of the vocabulary: this many at least, and one for so many training tokens.
PARTS, PART_TOKENS = 256, 4_000_000
#: Rounds end when a token's log likelihood (base e) gains less than this.
SETTLED = 1e-3
LONGEST = 1 << 20
#: Bytes of text in a chunk, and tokens that a task's recursion holds at a time.
CHUNK = 16 << 20
BATCH = 1_500_000
#: Tokens whose moves are summed at a time.
SLICE = 1 << 16
#: The end of a text is written as the empty word, which no text has.
END = ""


def held_out(id_column: Column) -> Column:
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % 5 == 1


# ---------------------------------------------------------------- (1) word numbers by chunk


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers as four planes of bytes, which compress well."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


_CHUNKS = "chunk long, held_out boolean, ids binary, local int, word string, n long"


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of documents (with ids) and rows of distinct words (with local, word and training count n)."""
    task, made = TaskContext.get().partitionId(), 0
    for part in filled(bounded(batches, most_bytes=CHUNK), most_bytes=CHUNK):
        words, bounds = flat_words(part.column("text"))
        coded = words.dictionary_encode()
        known = len(coded.dictionary)
        ids = coded.indices.to_numpy(zero_copy_only=False)
        kept = ~part.column("held_out").to_numpy(zero_copy_only=False)
        train = np.repeat(kept, np.diff(bounds))
        counts = np.append(np.bincount(ids[train], minlength=known), kept.sum())  # the last is the end
        docs, size = part.num_rows, known + 1
        texts = [_packed(np.append(ids[a:z], known)) for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        chunk = (task << 32) | made
        made += 1
        spelled = pa.concat_arrays([coded.dictionary.cast(pa.string()), pa.array([END])])
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.concat_arrays([part.column("doc_id"), pa.nulls(size, part.column("doc_id").type)]),
                "chunk": pa.array(np.full(docs + size, chunk)),
                "held_out": pa.concat_arrays([part.column("held_out"), pa.nulls(size, pa.bool_())]),
                "ids": pa.concat_arrays([pa.array(texts, pa.binary()), pa.nulls(size, pa.binary())]),
                "local": pa.concat_arrays([pa.nulls(docs, pa.int32()), pa.array(np.arange(size, dtype=np.int32))]),
                "word": pa.concat_arrays([pa.nulls(docs, pa.string()), spelled]),
                "n": pa.concat_arrays([pa.nulls(docs, pa.int64()), pa.array(counts.astype(np.int64))]),
            }
        )


# ---------------------------------------------------------------- (2) counts and places


@dataclass(frozen=True)
class Totals:
    """What the corpus' counts come to; a class is a word, and the one after the last that of unknown words."""

    tokens: int
    words: int
    discount: float
    class_tokens: np.ndarray
    class_words: np.ndarray

    @property
    def unknown(self) -> int:
        return len(self.class_tokens)

    @property
    def given_up(self) -> np.ndarray:
        """The share of a class' counts that goes to unknown words."""
        return self.discount * self.class_words / np.maximum(self.class_tokens, 1)

    def base(self, counts: np.ndarray) -> np.ndarray:
        """log10 of a word's share of all tokens, half a count added to each word and the unknown one."""
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.words + 1)))

    def inner(self, counts: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """log10 of P(word | class); 0 for unknown words, which are one word."""
        left = np.append(self.class_tokens - self.discount * self.class_words, 1.0)[classes]
        return np.where(counts > 0, np.log10(np.maximum(counts - self.discount, 1e-9) / np.maximum(left, 1e-9)), 0.0)


#: Kinds of rows: expected counts, places of words that a chunk has in training texts, sums of a chunk, places of its other words.
_EXPECTED, _TRAINED, _SUMS, _HELD = range(4)
_LISTS = "part int, kind int, chunk long, places binary, locals binary, counts binary, expected binary, sums array<double>"


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of words, sorted by part, chunk and kind, as a row for each of these (or a few)."""
    for batch in batches:
        names = ("part", "chunk", "kind", "place", "local", "c")
        part, chunk, kind, place, local, c = (batch.column(n).to_numpy(zero_copy_only=False) for n in names)
        starts = np.flatnonzero(np.concatenate(([True], (np.diff(part) != 0) | (np.diff(chunk) != 0) | (np.diff(kind) != 0))))
        cuts = list(zip(starts.tolist(), [*starts[1:].tolist(), len(part)], strict=True))
        yield _rows(
            part=[int(part[a]) for a, _ in cuts],
            kind=[int(kind[a]) for a, _ in cuts],
            chunk=[int(chunk[a]) for a, _ in cuts],
            places=[place[a:z].astype("<u4").tobytes() for a, z in cuts],
            locals=[local[a:z].astype("<u4").tobytes() for a, z in cuts],
            counts=[c[a:z].astype("<i8").tobytes() for a, z in cuts],
        )


def _rows(**columns: list) -> pa.RecordBatch:
    """A batch of _LISTS; columns that aren't given are null."""
    size = len(next(iter(columns.values())))
    kinds = {"part": pa.int32(), "kind": pa.int32(), "chunk": pa.int64(), "sums": pa.list_(pa.float64())}
    names = [c.split()[0] for c in _LISTS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns.get(n, [None] * size), kinds.get(n, pa.binary())) for n in names], names=names)


def _free(rows: DataFrame) -> None:
    """Let Spark delete the shuffle files of earlier jobs, which it does when the driver collects garbage."""
    rows.sparkSession.sparkContext._jvm.System.gc()


def _lexicon(kept: Kept, words: DataFrame) -> tuple[DataFrame, Totals]:
    """Rows of _LISTS with the places of each chunk's words in each part, and the totals.

    words has a row for each word of each chunk, so a word meets in one task with as many rows as there
    are chunks, not tokens; they cross the network once to be summed. Words that a chunk has in its
    held-out texts only are listed apart, as _HELD: no round needs them.
    """
    own = Kept()
    tokens = words.agg(F.sum("n")).first()[0] or 0
    parts = max(PARTS, tokens // PART_TOKENS)
    dealt = words.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(parts)).cast("int")).repartition("part")
    word = W.partitionBy("part", "word").orderBy("chunk")
    every = word.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    counted = dealt.withColumn("c", F.sum("n").over(every)).withColumn("first", F.row_number().over(word) == 1)
    counted = counted.withColumn("place", F.dense_rank().over(W.partitionBy("part").orderBy("word")) - 1)
    counted = counted.withColumn("kind", F.when(F.col("n") > 0, _TRAINED).otherwise(_HELD))
    counted = own.write(counted.select("part", "chunk", "kind", "local", "place", "c", "first"), "counted")
    sums = counted.where("first AND c > 0").agg(
        F.count(F.lit(1)).alias("words"),
        F.count(F.when(F.col("c") == 1, 1)).alias("once"),
        F.count(F.when(F.col("c") == 2, 1)).alias("twice"),
    ).first()
    discount = min(max(sums.once / (sums.once + 2 * sums.twice), 0.1), 0.9) if sums.once + sums.twice else 0.5
    lists = counted.drop("first").repartition("part").sortWithinPartitions("part", "chunk", "kind", "local").mapInArrow(_listed, _LISTS)
    lists = kept.write(lists, "lists")
    own.drop()
    _free(words)
    return lists, Totals(tokens, sums.words, discount, np.zeros(0), np.zeros(0))


# ---------------------------------------------------------------- the recursions


@dataclass(frozen=True)
class Model:
    start: np.ndarray  # (states,)
    moves: np.ndarray  # (states, states)
    emits: np.ndarray  # (classes, states)

    def log10_likelihood(self, sequences: list[np.ndarray]) -> np.ndarray:
        """log10 P(sequence) for each, by the scaled forward recursion."""
        laid = Sequences(sequences)
        total = np.zeros(len(laid))
        for t, alive in enumerate(laid.alive):
            at = laid.start[t]
            now = self.emits[laid.tokens[at : at + alive]]
            now = now * self.start if t == 0 else now * (before[:alive] @ self.moves)
            scale = now.sum(axis=1)
            total[:alive] += np.log10(scale)
            before = now / scale[:, None]
        out = np.zeros(len(laid))
        out[laid.order] = total
        return out

    def expected(self, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected counts of first states, of moves, and of emitted classes by state (forward-backward)."""
        return self.expected_and_likelihood(sequences)[:3]

    def expected_and_likelihood(self, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """The expected counts, and the log likelihood (base e) of all sequences."""
        laid = Sequences(sequences)
        classes, states = self.emits.shape
        moves = np.zeros((states, states))
        if not len(laid.tokens):
            return np.zeros(states), moves, np.zeros((classes, states)), 0.0
        emits, change = self.emits.astype(np.float32), self.moves.astype(np.float32)
        weight, back = emits[laid.tokens], np.ascontiguousarray(change.T)
        share = np.empty((len(laid.tokens), states), np.float32)
        scales = np.empty(len(laid.tokens), np.float32)
        ones, spans = np.ones(states, np.float32), list(zip(laid.start.tolist(), laid.alive.tolist(), strict=False))
        # A long text leaves many times with few sequences, so a time takes as few calls as it can.
        for t, (at, alive) in enumerate(spans):
            now, scale = share[at : at + alive], scales[at : at + alive]
            if t == 0:
                np.multiply(weight[:alive], self.start.astype(np.float32), out=now)
            else:
                np.matmul(before[:alive], change, out=now)
                now *= weight[at : at + alive]
            np.matmul(now, ones, out=scale)
            now /= scale[:, None]
            before = now
        weight /= scales[:, None]
        room = np.empty((len(laid), states), np.float32)
        for t in range(len(spans) - 1, 0, -1):
            # From here on a weight is the emission times the backward value, scaled.
            (at, alive), was = spans[t], spans[t - 1][0]
            weight[was : was + alive] *= np.matmul(weight[at : at + alive], back, out=room[:alive])
        # A posterior is what the forward shares of the time before foretell, times that weight.
        head, gone = len(laid), np.repeat(laid.alive[:-1], laid.alive[1:])
        first = weight[:head] * self.start.astype(np.float32)
        for i in range(0, len(gone), SLICE):
            here = slice(head + i, head + min(i + SLICE, len(gone)))
            old = share[np.arange(here.start, here.stop) - gone[i : i + SLICE]]
            moves += old.T @ weight[here]
            weight[here] *= old @ change
        weight[:head] = first
        emitted = np.stack([np.bincount(laid.tokens, weight[:, k], classes) for k in range(states)], axis=1)
        return first.sum(axis=0, dtype=np.float64), moves * self.moves, emitted, float(np.log(scales).sum(dtype=np.float64))


def _shares(first: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (first + 0.1) / (first + 0.1).sum(), (moves + 0.1) / (moves + 0.1).sum(axis=1, keepdims=True)


def _maximised(first: np.ndarray, moves: np.ndarray, emitted: np.ndarray, unigram: np.ndarray) -> Model:
    """A model from expected counts, with a little of the unigram shares in each state."""
    emitted = emitted + 1e-9 + unigram[:, None]
    return Model(*_shares(first, moves), emitted / emitted.sum(axis=0))


def with_unknown(model: Model, totals: Totals, unknown: np.ndarray | None = None) -> Model:
    """The model with the class of unknown words, to which each class gives up its share.

    unknown has these shares by state where the model holds only some of the words.
    """
    given = totals.given_up[:, None]
    unknown = (model.emits * given).sum(axis=0) if unknown is None else unknown
    return Model(model.start, model.moves, np.concatenate((model.emits * (1 - given), np.maximum(unknown, 1e-12)[None])))


# ---------------------------------------------------------------- (3) training


def _noise(part: int, places: np.ndarray, states: int, seed: int) -> np.ndarray:
    """Numbers of a gamma(1) distribution, by word and state whatever the order (splitmix64)."""
    x = (np.uint64(part << 32) + places.astype(np.uint64))[:, None] * np.uint64(states) + np.arange(states, dtype=np.uint64)
    x = (x + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return -np.log(((x >> np.uint64(11)).astype(float) + 0.5) / (1 << 53))


@dataclass(frozen=True)
class Emissions:
    """Shares of all words by state, spread over the parts.

    expected has rows of _LISTS with expected counts, or is None at the start. sums are those of a
    part's numbers over all words, by state.
    """

    lists: DataFrame
    expected: DataFrame | None
    totals: Totals
    states: int
    seed: int
    sums: np.ndarray | None = None

    def _numbers(self):
        """A function from a stream of rows, sorted by part and kind, to (row, places, counts, numbers) for each list."""
        states, seed, tokens, start = self.states, self.seed, max(self.totals.tokens, 1), self.expected is None

        def run(batches: Iterator[pa.RecordBatch]):
            at, held = None, np.zeros((0, states))
            for batch in batches:
                for row in batch.to_pylist():
                    if row["part"] != at:
                        at, held = row["part"], np.zeros((0, states))
                    places = np.frombuffer(row["places"], "<u4").astype(np.int64)
                    if (top := int(places.max()) + 1) > len(held):
                        held = np.concatenate((held, np.zeros((max(top, 2 * len(held)) - len(held), states))))
                    if row["kind"] == _EXPECTED:
                        held[places] += np.frombuffer(row["expected"], "<f4").reshape(-1, states)
                        continue
                    counts = np.frombuffer(row["counts"], "<i8")
                    share = (counts / tokens)[:, None] + 1e-9
                    numbers = share * _noise(at, places, states, seed) if start else held[places] + share
                    yield row, places, counts, numbers * (counts > 0)[:, None]

        return run

    def _dealt(self, every: bool = False) -> DataFrame:
        rows = self.lists if every else self.lists.where(F.col("kind") == _TRAINED)
        if self.expected is not None:
            rows = rows.unionByName(self.expected.where(F.col("kind") == _EXPECTED))
        return rows.repartition("part").sortWithinPartitions("part", "kind")

    def summed(self) -> tuple[np.ndarray, np.ndarray]:
        """Sums by state of the words' numbers, and of the part of them that they give up to unknown words."""
        states, discount, each = self.states, self.totals.discount, self._numbers()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, at, seen = np.zeros(2 * states), None, np.zeros(0, bool)
            for row, places, counts, numbers in each(batches):
                if row["part"] != at:
                    at, seen = row["part"], np.zeros(0, bool)
                if (top := int(places.max()) + 1) > len(seen):
                    seen = np.concatenate((seen, np.zeros(max(top, 2 * len(seen)) - len(seen), bool)))
                new = ~seen[places]
                seen[places] = True
                given = discount / np.maximum(counts, 1)
                total += np.concatenate((numbers[new].sum(axis=0), (numbers * given[:, None])[new].sum(axis=0)))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(2 * states)), pa.array(total)], names=["place", "value"])

        rows = self._dealt().mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
        total = np.zeros(2 * states)
        for r in rows.collect():  # two numbers for each state
            total[r.place] = r.value
        return total[:states], total[states:]

    def sent(self, counted: bool = False) -> DataFrame:
        """Rows of _LISTS, one for each list, with the words' shares in expected; if asked, with counts and for held-out texts too."""
        each, sums = self._numbers(), self.sums

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = ["part", "kind", "chunk", "locals", "counts" if counted else "places", "expected"]
            made, size = [], 0
            for row, _, _, numbers in each(batches):
                made.append(row | {"expected": (numbers / sums).astype("<f4").tobytes()})
                size += len(numbers)
                if size >= 200_000:
                    yield _rows(**{n: [r[n] for r in made] for n in names})
                    made, size = [], 0
            if made:
                yield _rows(**{n: [r[n] for r in made] for n in names})

        return self._dealt(every=counted).mapInArrow(run, _LISTS)


def _table(found: pa.Table, states: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Shares and counts (if sent) of a chunk's words by number, and the numbers in each row."""
    rows = [np.frombuffer(x, "<u4").astype(np.int64) for x in found.column("locals").to_pylist()]
    size = 1 + max(int(x.max()) for x in rows)
    emits, counts = np.zeros((size, states)), np.zeros(size, np.int64)
    for own, c, e in zip(rows, found.column("counts").to_pylist(), found.column("expected").to_pylist(), strict=True):
        emits[own] = np.frombuffer(e, "<f4").reshape(-1, states)
        if c is not None:
            counts[own] = np.frombuffer(c, "<i8")
    return emits, counts, rows


def _batched(sequences: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Sequences in turn, as many as have BATCH tokens, or one."""
    made, size = [], 0
    for s in sequences:
        if made and size + len(s) > BATCH:
            yield made
            made, size = [], 0
        made.append(s)
        size += len(s)
    if made:
        yield made


def _round(kept: Kept, train: DataFrame, start: np.ndarray, moves: np.ndarray, emits: Emissions) -> tuple[Emissions, list[np.ndarray]]:
    """Expected counts of all training documents: by word in a table, and (first, moves, by state, likelihood)."""
    states = emits.states

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return pa.Table.from_batches([_rows(part=[])])
        shares, _, rows = _table(found, states)
        numbers = [_unpacked(x) for x in texts.column("ids").to_pylist()]
        stretches = [s[i : i + LONGEST] for s in numbers for i in range(0, len(s), LONGEST)]
        model, total, emitted = Model(start, moves, shares), np.zeros(states + states * states + 1), np.zeros(shares.shape)
        for own in _batched(stretches):
            first, moved, out, likelihood = model.expected_and_likelihood(own)
            total += np.concatenate((first, moved.ravel(), [likelihood]))
            emitted += out
        sums = np.concatenate((total[:-1], emitted.sum(axis=0), total[-1:]))
        made = _rows(
            part=[*found.column("part").to_pylist(), -1],
            kind=[_EXPECTED] * len(rows) + [_SUMS],
            places=[*found.column("places").to_pylist(), None],
            expected=[*(emitted[x].astype("<f4").tobytes() for x in rows), None],
            sums=[None] * len(rows) + [sums.tolist()],
        )
        return pa.Table.from_batches([made])

    both = train.groupBy("of").cogroup(emits.sent().groupBy("chunk"))
    expected = kept.write(both.applyInArrow(run, _LISTS), "expected")
    summed = expected.where(F.col("kind") == _SUMS).select(F.posexplode("sums").alias("place", "value")).groupBy("place").agg(F.sum("value").alias("value"))
    total = np.zeros(2 * states + states * states + 1)
    for r in summed.collect():  # no more than moves and states
        total[r.place] = r.value
    first, moved, occupied, likelihood = np.split(total, np.cumsum([states, states * states, states]))
    sums = occupied + 1e-9 * emits.totals.words + 1
    return replace(emits, expected=expected, sums=sums), [first, moved.reshape(states, states), likelihood]


def train(
    kept: Kept, docs: DataFrame, lists: DataFrame, totals: Totals, states: int = STATES, rounds: int | None = None, seed: int = 42
) -> tuple[np.ndarray, np.ndarray, Emissions]:
    """Baum-Welch over all training documents until the likelihood settles, or for a given number of rounds."""
    moves = np.full((states, states), 0.1 / max(states - 1, 1)) + np.eye(states) * 0.9
    start, moves = np.full(states, 1 / states), moves / moves.sum(axis=1, keepdims=True)
    emits = Emissions(lists, None, totals, states, seed)
    emits = replace(emits, sums=np.maximum(emits.summed()[0], 1e-300))
    if not totals.tokens:
        return start, moves, emits  # there is no training document
    rows, last, done, old = docs.where("NOT held_out").select("of", "ids"), -np.inf, 0, Kept()
    while rounds is None or done < rounds:
        new = Kept()
        emits, (first, moved, likelihood) = _round(new, rows, start, moves, emits)
        old.drop()
        _free(docs)
        start, moves = _shares(first, moved)
        old, done = new, done + 1
        if rounds is None and likelihood[0] - last < SETTLED * totals.tokens:
            break
        last = likelihood[0]
    kept.paths += old.paths
    return start, moves, emits


# ---------------------------------------------------------------- (4) scores


def scores(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", states: int = STATES, rounds: int | None = None) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one per document."""
    kept, first = Kept(), Kept()
    rows = docs.select(docs[id_column].alias("doc_id"), docs[text_column].alias("text"))
    rows = rows.withColumn("held_out", held_out(F.col("doc_id")))
    kind = rows.schema["doc_id"].dataType.simpleString()
    both = first.write(rows.mapInArrow(_numbered, f"doc_id {kind}, {_CHUNKS}"), "numbers")
    texts = both.where("ids IS NOT NULL").select("doc_id", F.col("chunk").alias("of"), "held_out", "ids")
    texts = kept.write(texts, "texts")
    lists, totals = _lexicon(kept, both.where("word IS NOT NULL").select("chunk", "local", "word", "n"))
    first.drop()
    start, moves, emits = train(kept, texts, lists, totals, states, rounds)
    unknown = emits.summed()[1] / emits.sums
    _free(texts)

    def run(own: pa.Table, found: pa.Table) -> pa.Table:
        shares, counts, _ = _table(found, states)
        here = replace(totals, class_tokens=counts, class_words=(counts > 0).astype(np.int64))
        model = with_unknown(Model(start, moves, shares), here, unknown)
        base, seen = totals.base(counts), counts > 0
        place = np.where(seen, np.arange(len(counts)), here.unknown)
        numbers = [_unpacked(x) for x in own.column("ids").to_pylist()]
        likelihoods = [model.log10_likelihood([place[s] for s in some]) for some in _batched(numbers)]
        return pa.table(
            {
                "doc_id": own.column("doc_id"),
                "held_out": own.column("held_out"),
                "n_tokens": pa.array([len(s) for s in numbers], pa.int64()),
                "n_known": pa.array([int(seen[s].sum()) for s in numbers], pa.int64()),
                "train_tokens": pa.array([totals.tokens] * len(numbers), pa.int64()),
                "base_score": pa.array([float(base[s].sum()) for s in numbers], pa.float64()),
                "score": pa.array(np.concatenate([np.zeros(0), *likelihoods])),
            }
        )

    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return texts.groupBy("of").cogroup(emits.sent(counted=True).groupBy("chunk")).applyInArrow(run, schema)
