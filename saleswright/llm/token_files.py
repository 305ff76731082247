"""Token ids of texts in entropy-coded files, and back."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator
from struct import pack

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saleswright.llm import rans
from saleswright.llm.common import joined_ids, listed, parts_of, table
from saleswright.storage import scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0
#: Bytes of text of a shard, about.
SHARD_BYTES = 256 * 1024**2
#: Units whose ids a worker remembers, twice: the newer and the older ones.
MEMO_UNITS = 1 << 19
#: Bytes of the texts, about, that are split before the units new to the worker are
#: encoded together.
_TEXT_BYTES = 8 * 1024**2
#: Units that are encoded as one text.
_JOINED = 64

#: The pre-tokenizer always cuts before a single blank between other characters.
_CUT = re.compile(r"(?<=[^\s᠎]) (?=[^\s᠎])")
#: White space side by side, in the classes of RE2, which knows ASCII only by ``\\s``.
_SPACE = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_BLANKS = _SPACE + _SPACE
#: The pattern also cuts between a letter or a digit and marks that are no apostrophe,
#: so a word is one unit with or without marks after it.
_MARKS = ".,;:!?#$%&*)"
_BEFORE_MARKS = "[0-9A-Za-zÀ-ÖØ-öø-ÿ]$"


class _Units:
    """Ids of units that begin alike; units not met for long are forgotten."""

    def __init__(self, tokenizer, before: str):
        self.tokenizer, self.before = tokenizer, before
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        names = tokenizer.get_vocab()
        #: Whether a token begins with a blank, as the byte alphabet writes it.
        self.opens = np.zeros(max(names.values(), default=0) + 1, bool)
        self.opens[[i for name, i in names.items() if name.startswith("Ġ")]] = True

    def ids(self, units: list[str]) -> list[bytes]:
        """Little-endian ids of each of these different units."""
        if len(self.known) > MEMO_UNITS:
            self.known, self.older = {}, self.known
        found = list(map(self.known.get, units))
        if None in found:
            self._learn([u for u, x in zip(units, found) if x is None])
            known = self.known
            found = [known[u] if x is None else x for u, x in zip(units, found)]
        return found

    def _learn(self, units: list[str]) -> None:
        before = list(map(self.older.get, units))
        self.known.update((u, x) for u, x in zip(units, before) if x is not None)
        units = [u for u, x in zip(units, before) if x is None]
        # Units without white space in or around them are cut apart again where
        # a token begins with a blank, so many are encoded as one text.
        alone, groups = [], []
        for at in range(0, len(units), _JOINED):
            group = units[at : at + _JOINED]
            if not self.before:
                alone += group
                continue
            text = " ".join(group)
            if text.split() != group or "᠎" in text:
                fit = [u.split() == [u] and "᠎" not in u for u in group]
                alone += [u for u, x in zip(group, fit) if not x]
                group = [u for u, x in zip(group, fit) if x]
            if group:
                groups.append(group)
        coded = self._encode([self.before + u for u in alone])
        self.known.update((u, pack(f"<{len(ids)}I", *ids)) for u, ids in zip(alone, coded))
        for group, ids in zip(groups, self._encode([" " + " ".join(g) for g in groups])):
            found = np.array(ids, "<u4")
            data = found.tobytes()
            starts = (4 * np.flatnonzero(self.opens[found])).tolist()
            ends = [*starts[1:], len(data)]
            self.known.update((u, data[a:b]) for u, a, b in zip(group, starts, ends, strict=True))

    def _encode(self, texts: list[str]) -> Iterator[list[int]]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return (found.ids for found in coded)


def _distinct(units: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The different units, and which of them each unit is."""
    found = units.dictionary_encode()
    return found.dictionary, found.indices.to_numpy()


class Tokens:
    """Ids of texts by the tokenizer, which sees each unit of a text once.

    Texts are cut only where the tokenizer's own pattern always cuts, so the
    ids of the units are the ids of the whole text. ``spaced`` remembers units
    by what follows their blank, ``bare`` those that begin without one. A text
    that holds an added token's own characters is given to the tokenizer whole,
    which makes them that token.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [token.content for token in added if token.content]
        self.spaced = _Units(self.tokenizer, " ")
        self.bare = _Units(self.tokenizer, "")

    def _spaced(self, units: pa.Array) -> list[bytes]:
        """Ids of different units that follow a blank."""
        words = pc.utf8_rtrim(units, characters=_MARKS)
        marked = pc.and_(pc.not_equal(words, units), pc.match_substring_regex(words, _BEFORE_MARKS))
        words, which = _distinct(pc.if_else(marked, words, units))
        words = listed(words)
        coded = self.spaced.ids(words)
        found = [coded[k] for k in which.tolist()]
        at = np.flatnonzero(marked.to_numpy(zero_copy_only=False))
        whole = listed(units.take(pa.array(at)))
        ends = [u[len(words[k]) :] for u, k in zip(whole, which[at].tolist())]
        different = list(set(ends))
        marks = dict(zip(different, self.bare.ids(different)))
        for k, end in zip(at.tolist(), ends):
            found[k] += marks[end]
        return found

    def _whole(self, text: str) -> np.ndarray:
        self.tokenizer.encode_special_tokens = False
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        self.tokenizer.encode_special_tokens = True
        return np.array(ids, "<u4")

    def _cut(self, text: str) -> np.ndarray:
        """Ids of a text with white space side by side."""
        units = _CUT.split(text)
        (first,) = self.bare.ids(units[:1])
        rest, which = _distinct(pa.array(units[1:], pa.large_string()))
        found = self._spaced(rest)
        return np.frombuffer(first + b"".join([found[k] for k in which]), "<u4")

    def _lines(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of texts that are cut at every newline and blank."""
        lines = pc.split_pattern(texts, "\n")
        line_of_text = lines.offsets.to_numpy()
        cut = pc.split_pattern(lines.values, " ")
        unit_of_line, units = cut.offsets.to_numpy(), cut.values
        sizes = np.diff(unit_of_line)
        spaced = np.ones(len(units), bool)
        spaced[unit_of_line[:-1]] = False
        bare_units, bare = _distinct(units.take(pa.array(unit_of_line[:-1])))
        spaced_units, others = _distinct(units.filter(pa.array(spaced)))
        newline, *firsts = self.bare.ids(["\n", *listed(bare_units)])
        coded = [b"", newline, *firsts, *self._spaced(spaced_units)]
        # The units in order; a newline follows each line but the last of a text,
        # which nothing does.
        place = np.arange(len(units)) + np.repeat(np.arange(len(sizes)), sizes)
        which = np.ones(len(units) + len(sizes), np.int64)
        which[unit_of_line[line_of_text[1:]] + line_of_text[1:] - 1] = 0
        which[place[~spaced]] = 2 + bare
        which[place[spaced]] = 2 + len(firsts) + others
        ids, ends = joined_ids(coded, which)
        cuts = ends[unit_of_line[line_of_text[1:-1]] + line_of_text[1:-1] - 1]
        return np.split(ids, cuts)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """32-bit ids of each text."""
        column = pa.array(texts, pa.large_string())
        added = np.zeros(len(texts), bool)
        for content in self.added:
            added |= pc.match_substring(column, content).to_numpy(zero_copy_only=False)
        blanks = pc.match_substring_regex(column, _BLANKS).to_numpy(zero_copy_only=False)
        plain = ~added & ~blanks
        lines = iter(self._lines(column.filter(pa.array(plain))) if plain.any() else ())
        return [
            next(lines) if p else self._whole(text) if a else self._cut(text)
            for text, p, a in zip(texts, plain, added)
        ]


_TOKENS: dict[int, Tokens] = {}


def _tokens(definition: str) -> Tokens:
    key = zlib.crc32(definition.encode())
    if key not in _TOKENS:
        _TOKENS[key] = Tokens(definition)
    return _TOKENS[key]


_BLOCK = (
    "struct<n: long, lanes: int, words: binary, states: binary, places: array<long>, "
    "checksums: array<long>, lengths: array<long>, docs: array<{id}>>"
)


def _segments(
    documents: Iterable[tuple[object, np.ndarray]],
) -> Iterator[list[list[tuple[object, np.ndarray]]]]:
    """Documents in order as segments of blocks."""
    segment: list[list[tuple[object, np.ndarray]]] = []
    block: list[tuple[object, np.ndarray]] = []
    in_block = in_segment = 0
    for doc in documents:
        block.append(doc)
        in_block += len(doc[1])
        if in_block >= rans.BLOCK_TOKENS:
            segment.append(block)
            in_segment += in_block
            block, in_block = [], 0
            if in_segment >= rans.SEGMENT_TOKENS:
                yield segment
                segment, in_segment = [], 0
    if block:
        segment.append(block)
    if segment:
        yield segment


def write_token_files(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
) -> None:
    """Write the ids of every whole text, each followed by ``end_id``.

    Documents are dealt over shards by ranges of their id (nulls first, rows
    with one id by a hash of the text) and stand in that order in every shard.
    A row of the files is a segment: its shard and number, the frequency table
    and the blocks, each with the ids and lengths of its documents. A null text
    is an empty one. A text of any length is one block; others share blocks.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).withColumn("tie", F.xxhash64("text"))
    # A shard is written by one task, so their number follows the texts.
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    ordered = rows.repartitionByRange(parts, "id", "tie").sortWithinPartitions("id", "tie")
    id_type = dict(rows.dtypes)["id"]
    schema = (
        "shard: int, segment: int, bits: int, symbols: binary, freqs: binary, n: long, "
        f"blocks: array<{_BLOCK.format(id=id_type)}>"
    )
    end = np.array([end_id], "<u4")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, np.ndarray]]:
        tokens = _tokens(shared.value)
        for batch in batches:
            for part in parts_of(batch, "text", _TEXT_BYTES):
                coded = tokens.encode(part.column("text").to_pylist())
                for doc, ids in zip(part.column("id").to_pylist(), coded):
                    yield doc, np.append(ids, end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        for number, segment in enumerate(_segments(documents(batches))):
            arrays = [np.concatenate([ids for _, ids in block]) for block in segment]
            shared_table = rans.make_table(np.concatenate(arrays))
            blocks = []
            for block, ids in zip(segment, arrays):
                coded = rans.encode_block(ids, shared_table)
                blocks.append(
                    {
                        "n": coded.n,
                        "lanes": coded.lanes,
                        "words": coded.words,
                        "states": coded.states,
                        "places": coded.places,
                        "checksums": coded.checksums,
                        "lengths": [len(x) for _, x in block],
                        "docs": [doc for doc, _ in block],
                    }
                )
            row = {
                "shard": shard,
                "segment": number,
                "bits": shared_table.bits,
                "symbols": shared_table.symbols.astype("<u4").tobytes(),
                "freqs": shared_table.freqs.astype("<u4").tobytes(),
                "n": sum(map(len, arrays)),
                "blocks": blocks,
            }
            yield pa.RecordBatch.from_pylist([row], schema=arrow)

    empty = spark.createDataFrame([], schema)
    arrow = _arrow_schema(empty)
    ordered.select("id", "text").mapInArrow(run, schema).write.parquet(path)


def _arrow_schema(df: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema)


def decode_documents(segment: dict) -> Iterator[tuple[int, object, np.ndarray]]:
    """Place in the segment, id and token ids of every document of a segment."""
    shared_table = rans.Table(
        segment["bits"],
        np.frombuffer(segment["symbols"], "<u4"),
        np.frombuffer(segment["freqs"], "<u4"),
    )
    owner = rans.symbol_of_slot(shared_table)
    place = 0
    for raw in segment["blocks"]:
        names = ("n", "lanes", "words", "states", "places", "checksums")
        ids = rans.decode_block(rans.Block(*[raw[x] for x in names]), shared_table, owner)
        at = 0
        for doc, length in zip(raw["docs"], raw["lengths"]):
            yield place + at, doc, ids[at : at + length]
            at += length
        place += at


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The documents of token files: id, first place, number and checksum of ids.

    Places count the ids of all documents before, over all shards. Only the
    totals of shards meet in one task; a damaged block raises an error.
    Returns ``id``, ``start``, ``n_tokens`` and ``ids_crc32``.
    """
    files = spark.read.parquet(path)
    sizes = files.select("shard", "segment", "n")
    shards = sizes.groupBy("shard").agg(F.sum("n").alias("of_shard"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("of_shard").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sizes.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(shards, "shard")
        .select("shard", "segment", (F.col("first") + F.col("inside")).alias("offset"))
    )
    blocks = files.schema["blocks"].dataType.elementType
    id_type = blocks["docs"].dataType.elementType.simpleString()
    schema = f"shard: int, segment: int, id: {id_type}, at: long, n_tokens: long, ids_crc32: long"
    arrow = _arrow_schema(spark.createDataFrame([], schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                segment = batch.slice(k, 1).to_pylist()[0]
                rows = [
                    {
                        "shard": segment["shard"],
                        "segment": segment["segment"],
                        "id": doc,
                        "at": at,
                        "n_tokens": len(ids),
                        "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes()),
                    }
                    for at, doc, ids in decode_documents(segment)
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return (
        files.mapInArrow(run, schema)
        .join(offsets, ["shard", "segment"])
        .select("id", (F.col("offset") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
    )


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the token files of all documents and read them back."""
    path = scratch_path(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return read_token_files(spark, path).withColumnRenamed("id", "doc_id")
