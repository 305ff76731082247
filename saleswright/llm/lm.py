"""Scoring of texts with a unigram model of words and an attention model.

One pass over the training rows gathers, task by task, how often each word and
each subword id occurs, and all ids of every document, cut into windows. The
counts give the unigram model and the classes of the ids; the windows train the
attention model in rounds, each of which takes its part of them: in a round each
task trains on its windows from the model of the round before, and the results
are averaged by the number of windows. A second pass scores every text.

Subword ids come from a public byte-pair vocabulary, word by word. The commonest
ids are classes of their own; the rest fall into classes by whether they open a
word and by their rank, and within a class by their counts. Two attention models
foretell the class of every id, and the mean of their chances counts:

- One goes from id to id, over all ids of the words before and of the word itself.
- One goes from word to word, so it looks back further: it foretells the class of
  the id that opens a word from those that open the words before. Inside a word,
  the two ids before give the chances of the next and of the word's end.

P(id) = P(class | tokens before) * P(id | class). A word is spelled by its ids and
by the chance that the id after it opens a word. The word's own frequency is mixed
in with weight ``MIX``.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby, repeat
from math import log10, prod
from operator import itemgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    StructField,
    StructType,
)

from saleswright.llm import attention
from saleswright.llm.attention import BLOCK
from saleswright.llm.common import carried, crc_rest, laid_out, listed, parts_of, table, text_bytes
from saleswright.storage import materialize

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Ids that are classes of their own.
HEAD = 240
#: Classes of the other ids, for each of opening a word or not.
BANDS = 8
#: Words of a training window; every training document is cut into such.
WINDOW = 8 * BLOCK
ROUNDS = 4
#: Windows of a shard in a round, about. A shard is trained on by itself, in the
#: order of its windows' keys, whatever tasks and files there are.
SHARD_WINDOWS = 2048
#: Windows in a step, and steps that a shard makes in a round at least, by going
#: over its windows again.
BATCH = 16
LEAST_STEPS = 100
RATE = 0.03
#: Taken off the count of everything that happened inside words after two ids.
DISCOUNT = 0.75
#: Weight of the model from id to id beside that from word to word.
SHARE = 0.5
#: Weight of the words' frequencies beside the spelling by subwords.
MIX = 0.75
#: Words whose counts are broadcast at most; the others are looked up by a join.
HOT_WORDS = 1 << 20
#: Words a task counts before it hands them on.
_COUNTED = 1 << 19
#: Bytes of the texts, about, whose different words are found together.
_TEXT_BYTES = 4 * 1024**2
#: Words that are spelled as one text, and what they must not have for that.
_JOINED = 128
_SPACES = re.compile(r"[^\S ]|\u180e")
#: Bytes of the block by which an allocator learns to keep memory.
_KEPT_BYTES = 8 * 1024**2
#: Ids of the texts, about, that are scored at a time.
_SCORED = 1 << 17
#: Blocks that are scored at a time; what is made of them fits a cache.
_BLOCKS = 128

WORD, ID, SAMPLE = 0, 1, 2


def word_hash(word: bytes) -> int:
    """Signed 64-bit hash that stands for a word in counts."""
    value = xxhash.xxh3_64_intdigest(word)
    return value - (1 << 64) if value >> 63 else value


@dataclass(frozen=True)
class Words:
    """The different words of some texts, and which of them each text has.

    ``which`` has the words of all texts in order, those of a text from one of
    ``offsets`` to the next.
    """

    different: list[bytes]
    which: np.ndarray
    offsets: np.ndarray

    @property
    def numbers(self) -> np.ndarray:
        """How many words each text has."""
        return np.diff(self.offsets)

    @property
    def texts(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.numbers)


def _as(values: pa.Array, kind: pa.DataType) -> pa.Array:
    """The same bytes as another type, whether they are UTF-8 or not."""
    return pa.Array.from_buffers(kind, len(values), values.buffers(), offset=values.offset)


def words_in(texts: pa.Array) -> Words:
    """Words between ASCII white space, A-Z in lower case."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(_as(texts, pa.string())))
    real = pc.greater(pc.binary_length(cut.values), 0)
    before = np.append(0, np.cumsum(real.to_numpy(zero_copy_only=False)))
    found = cut.values.filter(real).dictionary_encode()
    return Words(
        listed(_as(found.dictionary, pa.binary())),
        found.indices.to_numpy(),
        before[cut.offsets.to_numpy()],
    )


class Subwords:
    """Ids of words; the id after the last stands for the end of a text."""

    def __init__(self, ranks: dict[bytes, int]):
        self.encoding = tiktoken.Encoding(
            "words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.end = max(ranks.values()) + 1
        self.opens = np.zeros(self.end + 1, bool)
        self.opens[[i for b, i in ranks.items() if b[:1] == b" "] + [self.end]] = True

    def ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these words, one after the other, and how many each has."""
        found, lengths = [np.zeros(0, "<i4")], [np.zeros(0, np.int64)]
        for at in range(0, len(words), _JOINED):
            group = words[at : at + _JOINED]
            text = b" ".join(group).decode("utf-8", "replace")
            if _SPACES.search(text):
                alone = [self._encode(w.decode("utf-8", "replace")) for w in group]
                found += alone
                lengths.append(np.array([len(ids) for ids in alone]))
            else:
                # Without white space in words, an id that begins with a blank begins a word.
                ids = self._encode(text)
                found.append(ids)
                lengths.append(np.diff(np.append(np.flatnonzero(self.opens[ids]), len(ids))))
        return np.concatenate(found), np.concatenate(lengths)

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(" " + text), "<i4")

    def spell(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the texts, each between two ends; the text's last place; ids a word has.

        The last of these are those of the words and of the end after each text.
        """
        own, lengths = self.ids(words.different)
        texts = len(words.numbers)
        which = np.zeros(len(words.which) + 2 * texts, np.int64)
        which[np.arange(len(words.which)) + 2 * words.texts + 1] = words.which + 1
        ids, ends = laid_out(np.append(np.int32(self.end), own), np.append(1, lengths), which)
        lasts = words.offsets[1:] + 2 * np.arange(1, texts + 1) - 1
        kept = np.ones(len(which), bool)
        kept[lasts - words.numbers - 1] = False
        return ids, ends[lasts], np.diff(ends, prepend=0)[kept]


def windows_of(ids: np.ndarray, opening: np.ndarray) -> list[bytes]:
    """Ids of a whole text in windows; the last id of each is the first of the next.

    So every id of the text, and its end, is a target once. ``opening`` are the
    places of the ids that open words and of the ends; windows begin at such.
    """
    data = ids.tobytes()
    bounds = (4 * np.append(opening[:-1:WINDOW], opening[-1])).tolist()
    return [data[at : to + 4] for at, to in zip(bounds, bounds[1:])]


def load_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary file: bytes and id of every subword."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def _keep_memory() -> None:
    """Let the worker's allocator keep the memory of arrays that are made again and again.

    It gives memory back to the system, to be had again page by page, when more is
    free than twice the largest block that it has seen freed, so it sees one.
    """
    np.empty(_KEPT_BYTES, np.uint8)


_SUBWORDS: dict[int, Subwords] = {}


def _subwords(ranks: dict[bytes, int]) -> Subwords:
    if len(ranks) not in _SUBWORDS:
        _SUBWORDS[len(ranks)] = Subwords(ranks)
    return _SUBWORDS[len(ranks)]


def _gather(train: DataFrame, ranks) -> DataFrame:
    """Rows (kind, key, n, ids): word counts, id counts, and training windows."""
    schema = "kind int, key long, n long, ids binary"

    def rows(kind, keys, counts, ids=None):
        return pa.RecordBatch.from_arrays(
            [
                pa.array([kind] * len(keys), pa.int32()),
                pa.array(keys, pa.int64()),
                pa.array(counts, pa.int64()),
                pa.array(ids or [None] * len(keys), pa.binary()),
            ],
            ["kind", "key", "n", "ids"],
        )

    def counted(words: dict[bytes, int]) -> pa.RecordBatch:
        return rows(WORD, list(map(word_hash, words)), list(words.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _keep_memory()
        subwords = _subwords(ranks.value)
        total: dict[bytes, int] = {}
        ids = np.zeros(subwords.end + 1, np.int64)
        for batch in batches:
            for part in parts_of(batch, "text", _TEXT_BYTES):
                words = words_in(part.column("text"))
                counts = np.bincount(words.which, minlength=len(words.different)).tolist()
                seen = map(total.get, words.different, repeat(0))
                total.update(zip(words.different, map(sum, zip(seen, counts))))
                spelled_ids, ends, _ = subwords.spell(words)
                ids += np.bincount(spelled_ids, minlength=len(ids))
                # Every text has the end's id before it as well.
                ids[subwords.end] -= part.num_rows
                keys, windows = [], []
                starts = np.append(0, ends[:-1])
                opening = np.flatnonzero(subwords.opens[spelled_ids])
                opening = np.split(opening, opening.searchsorted(starts[1:]))
                for text, at, to, own in zip(part.column("text"), starts, ends, opening):
                    found = windows_of(spelled_ids[at:to], own - at)
                    # A text's windows go to the rounds in turn.
                    draw = xxhash.xxh3_64_intdigest(text.as_buffer()) >> 2
                    keys += range(draw, draw + len(found))
                    windows += found
                yield rows(SAMPLE, keys, [1] * len(keys), windows)
                if len(total) > _COUNTED:
                    yield counted(total)
                    total = {}
        yield counted(total)
        found = np.flatnonzero(ids)
        yield rows(ID, found, ids[found])

    return train.select("text").mapInArrow(run, schema)


@dataclass(frozen=True)
class Classes:
    """The class of every id, and the log10 probability of the id in its class.

    ``frequency`` and ``opens`` (1 for classes whose ids open a word) are by class.
    Classes that open a word come first; the model from word to word has no others.
    """

    of: np.ndarray
    inside: np.ndarray
    frequency: np.ndarray
    opens: np.ndarray

    @property
    def words(self) -> int:
        return int(self.opens.sum())

    @property
    def n(self) -> int:
        return len(self.frequency)

    @property
    def of_themselves(self) -> Classes:
        """The same classes, with themselves for ids."""
        return Classes(np.arange(self.n, dtype=np.int32), np.zeros(self.n), self.frequency, self.opens)


def make_classes(counts: np.ndarray, opens: np.ndarray) -> Classes:
    """Commonest ids alone, the others by ``opens`` and by doublings of the rank."""
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(counts), np.int64)
    rank[order] = np.arange(len(counts))
    band = np.log2(np.maximum(rank, HEAD) / HEAD).astype(np.int64).clip(0, BANDS - 2)
    band = np.where(counts == 0, BANDS - 1, band)
    of = np.where(rank < HEAD, rank, HEAD + 2 * band + opens)
    # Classes without ids would only take probability.
    of = np.unique(of + np.where(opens > 0, 0, HEAD + 2 * BANDS), return_inverse=True)[1]
    size = int(of.max()) + 1
    opening = np.zeros(size, np.float32)
    opening[of] = opens
    weight = counts + 0.5
    total = np.bincount(of, weights=weight, minlength=size)
    return Classes(
        of.astype(np.int32),
        np.log10(weight / total[of]),
        (total + 0.5) / (total + 0.5).sum(),
        opening,
    )


def words_of(sequences: Sequence[np.ndarray], classes: Classes) -> list[np.ndarray]:
    """Classes of the ids that open words, and of ends, of each sequence.

    The first id of a sequence counts as one of class 0 if it opens no word.
    """
    lengths = np.array([len(s) for s in sequences])
    starts = np.cumsum(lengths) - lengths
    found = classes.of[np.concatenate(sequences)]
    found[starts] = np.where(found[starts] < classes.words, found[starts], 0)
    opening = found < classes.words
    return np.split(found[opening], np.append(0, np.cumsum(opening))[starts[1:]])


def _blocks(sequences: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, targets (-1: none) and first marks of the sequences' blocks."""
    sizes = np.array([-(-(len(s) - 1) // BLOCK) for s in sequences])
    starts = np.cumsum(sizes) - sizes
    inputs = np.zeros(sizes.sum() * BLOCK, np.int32)
    targets = np.full(sizes.sum() * BLOCK, -1, np.int32)
    for s, at in zip(sequences, starts * BLOCK):
        inputs[at : at + len(s) - 1] = s[:-1]
        targets[at : at + len(s) - 1] = s[1:]
    first = np.zeros(sizes.sum(), bool)
    first[starts] = True
    return inputs.reshape(-1, BLOCK), targets.reshape(-1, BLOCK), first


def start(classes: Classes) -> np.ndarray:
    """Flat parameters of both models, that from word to word first."""
    return np.concatenate([attention.start(classes.words), attention.start(classes.n)])


def both(flat: np.ndarray, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    """The flat parameters of each model; those from id to id may be missing."""
    size = sum(map(prod, attention.shapes(classes.words).values()))
    return flat[:size], flat[size:]


class _Learner:
    """A model that is trained on sequences of classes."""

    def __init__(self, flat: np.ndarray, follow: np.ndarray):
        self.flat, self.adam = flat.copy(), attention.Adam(len(flat))
        self.follow = attention.by_class(follow)

    def learn(self, sequences: Sequence[np.ndarray], times: int, rate: float) -> None:
        rng = np.random.default_rng(len(sequences))
        for _ in range(times):
            order = rng.permutation(len(sequences))
            for at in range(0, len(order), BATCH):
                inputs, targets, first = _blocks([sequences[k] for k in order[at : at + BATCH]])
                grad = attention.gradient(self.flat, self.follow, inputs, first, targets)[1]
                self.adam.step(self.flat, grad, rate)


def train_windows(
    flat: np.ndarray,
    follow: np.ndarray,
    classes: Classes,
    chunks: Iterable[Sequence[np.ndarray]],
    rate: float,
) -> tuple[int, np.ndarray]:
    """Number of windows, and parameters after going over all of them.

    Windows that are too few for the least steps are gone over again. ``flat`` has
    the parameters of both models, or of the one from word to word alone.
    """
    w, (by_words, by_ids) = classes.words, both(flat, classes)
    words, ids = _Learner(by_words, follow[:w, :w]), _Learner(by_ids, follow)
    n = 0
    for windows in chunks:
        times = 1 if n else -(-LEAST_STEPS // -(-len(windows) // BATCH))
        words.learn(words_of(windows, classes), times, rate)
        if len(by_ids):
            ids.learn([classes.of[window] for window in windows], times, rate)
        n += len(windows)
    return n, np.concatenate([words.flat, ids.flat])


def _summed(made: DataFrame, size: int) -> tuple[int, np.ndarray]:
    """Sum over tasks of the counts and of the vectors that tasks have made."""
    made = materialize(made, "round")
    n = made.agg(F.sum("n")).first()[0] or 0
    parts = made.select(F.posexplode("flat").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x"))
    found = parts.toArrow()
    total = np.zeros(size)
    total[found.column("at").to_numpy()] = found.column("x").to_numpy()
    return n, total


def _chunks(windows: Iterable[bytes]) -> Iterator[list[np.ndarray]]:
    """Windows of classes, as many at a time as the least steps take."""
    own = []
    for ids in windows:
        own.append(np.frombuffer(ids, "<i2"))
        if len(own) == BATCH * LEAST_STEPS:
            yield own
            own = []
    if own:
        yield own


def _vectors(windows: DataFrame, make, shared) -> DataFrame:
    """Number of windows, and one vector from them, of every run of equal ``shard``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
        for batch in batches:
            yield from zip(batch.column("shard").to_pylist(), batch.column("ids").to_pylist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _keep_memory()
        for _, own in groupby(rows(batches), key=itemgetter(0)):
            n, flat = make(_chunks(ids for _, ids in own), *shared.value)
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int64()), pa.array([flat], pa.list_(pa.float64()))],
                ["n", "flat"],
            )

    return windows.select("shard", "ids").mapInArrow(run, "n long, flat array<double>")


def _context(found: np.ndarray, lengths: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the targets are in sequences of classes laid end to end, and the two classes before each.

    The first of a sequence is no target; its second has ``none`` before the first.
    """
    starts = np.cumsum(lengths) - lengths
    target = np.ones(len(found), bool)
    target[starts] = False
    older = np.empty_like(found)
    older[2:] = found[:-2]
    older[starts[lengths > 1] + 1] = none
    place = np.flatnonzero(target)
    return place, older[place], found[place - 1]


def _events(found: np.ndarray, classes: Classes) -> np.ndarray:
    """What happens inside a word: one of the classes that do not open one, or, last, its end."""
    return np.where(found < classes.words, classes.n - classes.words, found - classes.words)


def inside_shape(classes: Classes) -> tuple[int, int, int]:
    """Of counts by the class before the last (or none), the last class, and what happens."""
    return classes.n + 1, classes.n, classes.n - classes.words + 1


def _add(total: np.ndarray, places: np.ndarray) -> None:
    """One more at each of ``places``, repeats included; sorted, as ``total`` is too large for a cache."""
    places.sort()
    starts = np.flatnonzero(np.diff(places, prepend=-1))
    total[places[starts]] += np.diff(starts, append=len(places)).astype(total.dtype)


def count_follows(total: np.ndarray, ids: np.ndarray, lengths: np.ndarray, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    """Add to ``total`` what follows what in windows: inside words, then from word to word.

    Returns the classes that open the windows' words, and how many each window has.
    """
    shape, w = inside_shape(classes), classes.words
    found = classes.of[ids]
    place, older, before = _context(found, lengths, classes.n)
    _add(total, (older * shape[1] + before) * shape[2] + _events(found[place], classes))
    opening = found < w
    words = found[opening]
    numbers = np.add.reduceat(opening, np.cumsum(lengths) - lengths, dtype=np.int64)
    # A window's last word and the next window's first are no pair.
    pairs = np.delete(prod(shape) + w * words[:-1] + words[1:], np.cumsum(numbers)[:-1] - 1)
    _add(total, pairs)
    return words, numbers


def follow_of(inside: np.ndarray, words: np.ndarray, classes: Classes) -> np.ndarray:
    """Log probability (natural) of the class after each class, from sums of ``count_follows``.

    The chance that a word ends is dealt to the classes that open words by what
    opens the next word.
    """
    w = classes.words
    often = 20 * classes.frequency
    goes_on = inside.sum(axis=0, dtype=float) + np.append(often[w:], often[:w].sum())
    goes_on /= goes_on.sum(axis=1, keepdims=True)
    opens = np.tile(often[:w], (classes.n, 1))
    opens[:w] += words
    opens *= goes_on[:, -1:] / opens.sum(axis=1, keepdims=True)
    return np.log(np.concatenate([opens, goes_on[:, :-1]], axis=1)).astype(np.float32)


def inside_of(follow: np.ndarray, classes: Classes, counts: np.ndarray | None = None) -> np.ndarray:
    """Log probability (natural) of what happens after two classes, as ``inside_shape`` has it.

    What was counted after both is discounted by ``DISCOUNT`` for each thing that
    happened, and ``follow`` of the last class has what that leaves. Without
    counts, the class before the last makes no difference.
    """
    plain = np.exp(follow - follow.max(axis=1, keepdims=True))
    plain /= plain.sum(axis=1, keepdims=True)
    w = classes.words
    plain = np.concatenate([plain[:, w:], plain[:, :w].sum(axis=1, keepdims=True)], axis=1)
    found = np.empty((1 if counts is None else len(counts), *plain.shape), np.float32)
    for k in range(len(found)):
        own = np.zeros_like(plain) if counts is None else counts[k]
        left = DISCOUNT * (own > 0).sum(axis=1, keepdims=True)
        total = own.sum(axis=1, keepdims=True)
        seen = np.maximum(own - DISCOUNT, 0) + left * plain
        found[k] = np.where(total > 0, seen / np.maximum(total, 1), plain)
    return np.log(np.maximum(found, 1e-30, out=found), out=found)


def _followed(windows: DataFrame, classes: Classes) -> DataFrame:
    """Rows (key, ids) with the classes of all ids of each window, and rows (at, n) of counts."""
    shared = windows.sparkSession.sparkContext.broadcast(classes)
    names = ["key", "ids", "at", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _keep_memory()
        classes = shared.value
        counts = np.zeros(prod(inside_shape(classes)) + classes.words**2, np.int32)
        for whole in batches:
            for batch in parts_of(whole, "ids", _TEXT_BYTES):
                column = batch.column("ids")
                lengths = pc.binary_length(column).to_numpy() >> 2
                ids = np.frombuffer(column.buffers()[2], "<i4")
                first = np.frombuffer(column.buffers()[1], "<i4")[column.offset] >> 2
                ids = ids[first : first + lengths.sum()]
                count_follows(counts, ids, lengths, classes)
                ends = 2 * np.append(0, np.cumsum(lengths))
                buffers = [None, pa.py_buffer(ends.astype("<i4")), pa.py_buffer(classes.of[ids].astype("<i2"))]
                rows = pa.Array.from_buffers(pa.binary(), len(lengths), buffers)
                none = pa.nulls(len(rows), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("key"), rows, none, none], names)
        found = np.flatnonzero(counts)
        for at in range(0, len(found), 1 << 16):
            some = found[at : at + (1 << 16)]
            none = [pa.nulls(len(some), kind) for kind in (pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, pa.array(some), pa.array(counts[some], pa.int64())], names)

    return windows.select("key", "ids").mapInArrow(run, "key long, ids binary, at long, n long")


def _summed_follows(followed: DataFrame, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    """What is counted in all rows: inside words, and from word to word."""
    sums = followed.filter("at IS NOT NULL").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    shape, w = inside_shape(classes), classes.words
    total = np.zeros(prod(shape) + w * w, np.float32)
    total[sums.column("at").to_numpy()] = sums.column("n").to_numpy()
    return total[: prod(shape)].reshape(shape), total[prod(shape) :].reshape(w, w)


def _train(windows: DataFrame, classes: Classes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parameters from rounds over all shards, what follows each class, and what happens inside words.

    Windows are dealt to shards by what they are, and the number of shards follows
    that of the windows, so the model is the same however the rows lie.
    """
    spark = windows.sparkSession
    followed = materialize(_followed(windows, classes), "followed")
    counts, words = _summed_follows(followed, classes)
    follow = follow_of(counts, words, classes)
    windows = followed.filter("key IS NOT NULL")
    shards = max(1, -(-windows.count() // (ROUNDS * SHARD_WINDOWS)))
    flat = start(classes)
    for number in range(ROUNDS):
        rate = RATE * (1 - number / ROUNDS)

        def make(own, before, table_, known, rate=rate):
            n, flat = train_windows(before, table_, known, own, rate)
            return n, flat.astype(np.float64) * n

        part = (
            windows.filter(F.pmod("key", F.lit(ROUNDS)) == number)
            .select("key", "ids", F.pmod(F.xxhash64("key", "ids"), F.lit(shards)).alias("shard"))
            .repartition("shard")
            .sortWithinPartitions("shard", "key", "ids")
        )
        shared = spark.sparkContext.broadcast((flat, follow, classes.of_themselves))
        n, total = _summed(_vectors(part, make, shared), len(flat))
        if n:
            flat = (total / n).astype(np.float32)
    return flat, follow, inside_of(follow, classes, counts)


def _foretold(
    p: dict[str, np.ndarray], follow: np.ndarray, sequences: Sequence[np.ndarray], opens: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Log probability (natural) of every class after the first of each sequence, and of ``opens``."""
    inputs, targets, first = _blocks(sequences)
    logs, opening = np.zeros(inputs.size), np.zeros(inputs.size)
    follow = attention.by_class(follow)
    p = attention.first_classes(p, follow.classes)
    # Groups by whether their classes open a word: all, none, or some.
    sides = np.arange(0, follow.classes, attention.SIDE)
    share = np.add.reduceat(opens, sides) / np.diff(np.append(sides, follow.classes))
    whole = (share == 1).astype(np.float32)
    some = np.flatnonzero((share > 0) & (share < 1))
    for at in range(0, len(inputs), _BLOCKS):
        # The block before the slice is only read as context.
        lo = max(0, at - 1)
        x = attention.forward(p, follow, inputs[lo : at + _BLOCKS], first[lo : at + _BLOCKS])
        goal = targets[lo : at + _BLOCKS].ravel().copy()
        goal[: (at - lo) * BLOCK] = -1
        here = np.flatnonzero(goal >= 0)
        made = attention.heads(x, here, goal[here])
        place = made.at + lo * BLOCK
        logs[place] = made.logs
        if whole.all():
            continue
        opened = made.group @ whole
        before = x.classes.ravel()[made.at]
        for g in some:
            own = opens[g * attention.SIDE : (g + 1) * attention.SIDE]
            weights = attention.inside(x, made.z, before, g)
            weights = np.exp(weights - weights.max(axis=1, keepdims=True))
            opened += made.group[:, g] * (weights[:, : len(own)] @ own) / weights.sum(axis=1)
        opening[place] = np.log(np.maximum(opened, 1e-30))
    real = targets.ravel() >= 0
    return logs[real], opening[real]


def spelled(
    p: dict[str, np.ndarray],
    follow: np.ndarray,
    classes: Classes,
    sequences: Sequence[np.ndarray],
    inside: np.ndarray | None = None,
    by_ids: dict[str, np.ndarray] | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Log10 probability of every id after the first of each sequence, and that it opens a word.

    ``inside`` is what ``inside_of`` gives; without it, it follows from ``follow``.
    ``by_ids`` are the parameters of the model from id to id; without them, the
    one from word to word, which has ``p``, counts alone.
    """
    if inside is None:
        inside = inside_of(follow, classes)
    ids = np.concatenate(sequences)
    found = classes.of[ids]
    place, older, before = _context(found, np.array([len(s) for s in sequences]), classes.n)
    after = _events(found[place], classes)
    _, k, events = inside.shape
    row = (before if len(inside) == 1 else older * k + before) * events
    logs = inside.ravel()[row + after].astype(float)
    opening = inside.ravel()[row + events - 1].astype(float)
    w = classes.words
    words = words_of(sequences, classes)
    logs[after == events - 1] += _foretold(p, follow[:w, :w], words, classes.opens[:w])[0]
    if by_ids is not None:
        own = np.split(found, np.cumsum([len(s) for s in sequences])[:-1])
        other, opened = _foretold(by_ids, follow, own, classes.opens)
        logs = np.logaddexp(np.log(1 - SHARE) + logs, np.log(SHARE) + other)
        opening = np.logaddexp(np.log(1 - SHARE) + opening, np.log(SHARE) + opened)
    return logs / np.log(10) + classes.inside[ids[place]], opening / np.log(10)


def spellings(
    logs: np.ndarray, opening: np.ndarray, lengths: np.ndarray, ends: np.ndarray
) -> np.ndarray:
    """Log10 probability of every word's ids, which are ``lengths`` of those in ``logs``.

    ``ends`` marks the words that end a text and have no id after them.
    """
    starts = np.cumsum(lengths) - lengths
    spelling = np.add.reduceat(logs, starts) - opening[starts]
    after = np.append(opening[starts[1:]], 0.0)
    return spelling + np.where(ends, 0.0, after)


def mixed(spelling: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Log10 probability of words from their spellings and their own frequencies."""
    with np.errstate(divide="ignore"):
        known = np.log(MIX * shares)
    return np.logaddexp(known, np.log(1 - MIX) + spelling * np.log(10)) / np.log(10)


def joined_mixed(n: Column, spelling: Column, tokens: int) -> Column:
    """``mixed`` for a word that occurs ``n`` times among ``tokens``; null is never."""
    share = MIX * n / float(max(1, tokens))
    return F.when(n.isNull(), log10(1 - MIX) + spelling).otherwise(
        F.log10(share + (1 - MIX) * F.pow(F.lit(10.0), spelling))
    )


def _some(ids: np.ndarray, ends: np.ndarray) -> Iterator[list[np.ndarray]]:
    """Ids of each text, of so many texts at a time that they have about ``_SCORED``."""
    own = np.split(ids, ends[:-1])
    cuts = [0, *(np.flatnonzero(np.diff(ends // _SCORED)) + 1).tolist(), len(own)]
    for a, b in zip(cuts, cuts[1:]):
        yield own[a:b]


class _Looked:
    """What is known of words: base score, hash if rare, own frequency."""

    def __init__(self, keys, counts, tokens: int, scale: float):
        self.keys, self.counts = keys, counts
        self.tokens, self.scale = tokens, scale

    def look(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes = np.fromiter(map(word_hash, words), np.int64, len(words))
        counts = np.zeros(len(words))
        if len(self.keys):
            at = np.minimum(self.keys.searchsorted(hashes), len(self.keys) - 1)
            counts = np.where(self.keys[at] == hashes, self.counts[at], 0)
        hot = counts > 0
        base = np.where(hot, np.log10((counts + 0.5) / self.scale), 0.0)
        rare = np.where(hot, 0, np.where(hashes == 0, 1, hashes))
        return base, rare, counts / max(1, self.tokens)


def _score(rows: DataFrame, ranks, model, hot, tokens: int, scale: float, end: int) -> DataFrame:
    """Scores over hot words and the end, and hashes and spellings of all other words."""
    shared = rows.sparkSession.sparkContext.broadcast((model, hot))
    schema = StructType(
        [
            rows.schema["_row"],
            StructField("n_tokens", LongType()),
            StructField("known", LongType()),
            StructField("base", DoubleType()),
            StructField("score", DoubleType()),
            StructField("rare", ArrayType(LongType(), False)),
            StructField("spelling", ArrayType(DoubleType(), False)),
        ]
    )
    end_base = log10((end + 0.5) / scale)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _keep_memory()
        (flat, follow, inside, classes), (keys, counts) = shared.value
        by_words, by_ids = both(flat, classes)
        p, by_ids = attention.unpack(by_words, classes.words), attention.unpack(by_ids, classes.n)
        subwords = _subwords(ranks.value)

        known = _Looked(keys, counts, tokens, scale)
        for whole in batches:
            for batch in parts_of(whole, "_text", _TEXT_BYTES):
                texts = batch.num_rows
                words = words_in(batch.column("_text"))
                base, rare, share = (x[words.which] for x in known.look(words.different))
                ids, ends, lengths = subwords.spell(words)
                logs, opening = map(np.concatenate, zip(*(
                    spelled(p, follow, classes, some, inside, by_ids) for some in _some(ids, ends)
                )))
                # The words of all texts, with the end of each text after its own.
                last = words.offsets[1:] + np.arange(texts)
                word = np.ones(len(lengths), bool)
                word[last] = False
                spelling = spellings(logs, opening, lengths, ~word)
                shares = np.full(len(word), end / max(1, tokens))
                shares[word] = share
                other = np.zeros(len(word), bool)
                other[word] = rare != 0
                scores = np.where(other, 0.0, mixed(spelling, shares))
                scores = np.add.reduceat(scores, np.append(0, last[:-1] + 1))
                sums = np.bincount(words.texts, weights=base, minlength=texts) + end_base
                rares = np.bincount(words.texts[rare != 0], minlength=texts)
                offsets = pa.array(np.append(0, np.cumsum(rares)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_row"),
                        pa.array(words.numbers + 1, pa.int64()),
                        pa.array(words.numbers - rares + (end > 0), pa.int64()),
                        pa.array(sums),
                        pa.array(scores),
                        pa.ListArray.from_arrays(
                            offsets,
                            pa.array(rare[rare != 0], pa.int64()),
                            pa.list_(pa.field("element", pa.int64(), False)),
                        ),
                        pa.ListArray.from_arrays(
                            offsets,
                            pa.array(spelling[other], pa.float64()),
                            pa.list_(pa.field("element", pa.float64(), False)),
                        ),
                    ],
                    schema.names,
                )

    return rows.mapInArrow(run, schema)


def lm_scores(
    docs: DataFrame,
    learn: Column,
    text_col: str = "text",
    carry: Sequence[str] = ("doc_id",),
    ranks: str = RANKS,
) -> DataFrame:
    """Unigram and attention-model scores of every whole text.

    Both learn from all rows where ``learn`` holds. Null texts are empty ones
    and have the end as their only token. Words are counted by a 64-bit hash;
    counts of the commonest ``HOT_WORDS`` are broadcast, those of all others
    joined, and both kinds count alike in both scores. Without training rows
    counts are zero and the model is untrained.

    Returns the ``carry`` columns, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score`` (log10).
    """
    spark = docs.sparkSession
    vocabulary = load_ranks(ranks)
    shared = spark.sparkContext.broadcast(vocabulary)
    text = text_bytes(text_col)
    gathered = materialize(_gather(docs.filter(learn).select(text.alias("text")), shared), "gathered")
    counts = materialize(
        gathered.filter(F.col("kind") == WORD).groupBy("key").agg(F.sum("n").alias("n")), "words"
    )
    ids = np.zeros(max(vocabulary.values()) + 2, np.int64)
    for row in gathered.filter(F.col("kind") == ID).groupBy("key").agg(F.sum("n").alias("n")).collect():
        ids[row.key] = row.n
    opens = np.zeros(len(ids), np.int64)
    opens[[i for b, i in vocabulary.items() if b[:1] == b" "] + [len(ids) - 1]] = 1
    classes = make_classes(ids, opens)
    flat, follow, inside = _train(gathered.filter(F.col("kind") == SAMPLE), classes)

    end = int(ids[-1])
    sizes = counts.groupBy(F.floor(F.log2("n")).alias("doubling")).agg(
        F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")
    )
    sizes = sorted(sizes.collect(), key=lambda r: -r.doubling)
    train_tokens = sum(r.n for r in sizes) + end
    distinct = sum(r.words for r in sizes) + (end > 0)
    scale = train_tokens + 0.5 * (distinct + 1)
    bar, taken = 1 << 62, 0
    for row in sizes:
        taken += row.words
        if taken > HOT_WORDS:
            break
        bar = 1 << row.doubling
    common = counts.filter(F.col("n") >= bar).select("key", "n").toArrow().sort_by("key")
    hot = (common.column("key").to_numpy(), common.column("n").to_numpy())

    rows = docs.select(F.struct(*carry).alias("_row"), text.alias("_text"))
    scored = _score(rows, shared, (flat, follow, inside, classes), hot, train_tokens, scale, end)
    scored = materialize(scored.withColumn("at", F.monotonically_increasing_id()), "scored")
    looked = (
        scored.select("at", F.explode(F.arrays_zip("rare", "spelling")).alias("word"))
        .select("at", F.col("word.rare").alias("key"), F.col("word.spelling").alias("spelling"))
        .join(counts.filter(F.col("n") < bar), "key", "left")
        .groupBy("at")
        .agg(
            F.sum(F.log10((F.coalesce("n", F.lit(0)) + 0.5) / scale)).alias("more"),
            F.count("n").alias("more_known"),
            F.sum(joined_mixed(F.col("n"), F.col("spelling"), train_tokens)).alias("more_score"),
        )
    )
    return carried(
        scored.drop("rare", "spelling").join(looked, "at", "left"),
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", crc_rest("doc_id", 5) == 1)
    return lm_scores(docs, ~F.col("held_out"), carry=("doc_id", "held_out"))
