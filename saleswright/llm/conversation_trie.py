"""A trie of conversation prefixes, built from sorted shards of turn ids."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import sha256
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saleswright.llm.common import attach, table
from saleswright.session import temporary_conf
from saleswright.storage import materialize

#: Hex digits of a turn id: 128 bits of SHA-256, so that turns need no numbering.
ID_DIGITS = 32
#: Turns and conversations that are sorted together; a longer shard is cut.
SHARD_TURNS = 1 << 18
#: Columns of the padded matrix that are sorted at a time.
BLOCK = 16
#: Conversations that share turns lie in groups of so many ids.
FAMILY = 20

_NODE, _PART, _ENDS, _EDGE = range(4)
_SCHEMA = (
    "kind int, key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, cost long, once long, ends_sha256 string, "
    "ends binary, path string, words array<int>, last_path string, last_words array<int>"
)
_TYPES = {
    "kind": pa.int32(), "key": pa.binary(), "parent_key": pa.binary(), "depth": pa.int64(),
    "conv_id": pa.int64(), "parent_conv_id": pa.int64(), "n_convs": pa.int64(),
    "n_children": pa.int64(), "n_leaves": pa.int64(), "cost": pa.int64(), "once": pa.int64(),
    "ends_sha256": pa.string(), "ends": pa.binary(), "path": pa.string(),
    "words": pa.list_(pa.int32()), "last_path": pa.string(), "last_words": pa.list_(pa.int32()),
}
_NO_ENDS = sha256(b"").hexdigest()

_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform("
    "range(1, len(conv_id::VARCHAR) + 1), lambda i: [unicode((conv_id::VARCHAR)[i])::BIGINT, "
    "-1, -1, -1, -1, -1, -1, -1, -1]))), lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) "
    "ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"
)
ORACLE_SQL = rf"""
WITH turns AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
                       ORDER BY turn NULLS FIRST) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), shared AS (
  SELECT conv_id, own, conv_id - conv_id % 20 AS base, {_CRC} % 4 AS h FROM turns
), rebuilt AS (
  SELECT s.conv_id, coalesce(b.own, [])[1:s.h] || s.own[s.h + 1:] AS path
  FROM shared s LEFT JOIN turns b ON b.conv_id = s.base
), prefixes AS (
  SELECT conv_id, path[1:d] AS path, d, len(r.path) AS size
  FROM rebuilt r, unnest(range(0, len(r.path) + 1)) t(d)
), nodes AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS deepest,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = d), '') AS ends,
         CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(path[d].text, '[^\x20\x09-\x0D]+')) END
           AS words
  FROM prefixes GROUP BY path, d
), rolled AS (
  SELECT u.path[1:t.d] AS path, count(*) FILTER (u.deepest = u.d) AS n_leaves,
         count(*) FILTER (u.d = t.d + 1) AS n_children,
         sum((u.n_convs - 1) * u.words) AS saved_tokens
  FROM nodes u, unnest(range(0, u.d + 1)) t(d) GROUP BY 1
)
SELECT v.conv_id, v.d::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n_convs, r.n_children,
       r.n_leaves, r.saved_tokens::BIGINT AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM nodes v JOIN rolled r ON r.path = v.path
LEFT JOIN nodes p ON v.d > 0 AND p.path = v.path[1:v.d - 1]
"""


# --- sequences of turns


def sequences(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    family: Column | None = None,
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``ids`` and ``words`` of its turns in order.

    Turns go by number, null first, equal numbers by turn id. A turn id is a
    hash of role and text, a null in either counts as empty; ``words`` counts
    runs of anything but ASCII white space in the text. Rows without a
    conversation id belong to no conversation. ``family`` (of the id) brings
    conversations into one partition that are looked at together. What is
    shuffled of a turn is its number, id and count, and a conversation's turns
    in that form must fit one task.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.substring(F.sha2(named, 256), 1, ID_DIGITS).alias("id"),
            F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"),
        ).alias("turn"),
    )
    by = ["conv_id"]
    if family is not None:
        turns, by = turns.withColumn("family", family).repartition("family"), ["family", "conv_id"]
    whole = turns.groupBy(*by).agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return whole.select(*by, F.col("turns.id").alias("ids"), F.col("turns.words").alias("words"))


def share_heads(turns: DataFrame) -> DataFrame:
    """Let conversations of a family begin with the same turns.

    The first crc32(id) % 4 turns of a conversation become those of the
    conversation ``id - id % FAMILY``, or none where there is no such one.
    """
    first = Window.partitionBy("family")
    is_base = F.col("conv_id") == F.col("family")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")

    def rebuilt(name: str) -> Column:
        head = F.max(F.when(is_base, F.slice(name, 1, 3))).over(first)
        none = F.array().cast(f"array<{'string' if name == 'ids' else 'int'}>")
        return F.concat(F.slice(F.coalesce(head, none), F.lit(1), h), F.slice(F.col(name), h + 1, F.size(name)))

    return turns.select("conv_id", rebuilt("ids").alias("ids"), rebuilt("words").alias("words"))


# --- one shard


def sort_shard(
    conv: np.ndarray, lens: np.ndarray, ids: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by turn ids, then by conversation, and where each row begins.

    ``ids`` holds the two halves of the turn ids of all rows, one after the
    other. The padded matrix of a block of columns is sorted at a time, within
    the groups that the blocks before left; only groups with longer rows go on,
    so one long conversation does not widen the others. Changes against the row
    above are accumulated by OR along the row: from the first change on a row
    starts nodes of its own. Gives that depth, or one more than its length for
    a row that repeats the one above.
    """
    offs = np.concatenate([[0], np.cumsum(lens)[:-1]]).astype(np.int64)
    order = np.argsort(conv, kind="stable")
    own = lens + 1
    starts = np.zeros(len(conv), bool)
    starts[:1] = True
    depth = 0
    while len(conv):
        longest = np.maximum.reduceat(lens[order], np.flatnonzero(starts))
        if not (longest > depth).any():
            break
        group = np.cumsum(starts) - 1
        at = np.flatnonzero((longest > depth)[group])
        rows, group = order[at], group[at]
        width = min(BLOCK, int(longest.max()) - depth)
        place = depth + np.arange(width)
        there = place < lens[rows][:, None]
        matrix = np.where(there[:, :, None], ids[np.where(there, offs[rows][:, None] + place, 0)], 0)
        matrix = matrix.reshape(len(rows), -1)
        sort = np.lexsort((conv[rows], *matrix.T[::-1], group))
        order[at] = rows = rows[sort]
        matrix = matrix[sort]
        change = np.zeros((len(rows), width), bool)
        change[1:] = (matrix[1:] != matrix[:-1]).reshape(-1, width, 2).any(2)
        first = np.r_[True, group[1:] != group[:-1]]
        change[first, 0] = True
        np.logical_or.accumulate(change, axis=1, out=change)
        fresh = change[:, -1] & (~first | (depth == 0))
        own[rows[fresh]] = np.minimum(depth + change[fresh].argmax(axis=1) + 1, lens[rows[fresh]] + 1)
        starts[at] |= change[:, -1]
        depth += width
    return order, own


def _keys(path: str, depths: int) -> list[bytes]:
    """Keys of a path's first prefixes, from the root on."""
    state = sha256()
    keys = [state.digest()]
    for d in range(depths):
        state.update(path[d * ID_DIGITS : (d + 1) * ID_DIGITS].encode())
        keys.append(state.copy().digest())
    return keys


def _joined(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def _pack(ids: np.ndarray) -> bytes:
    """Ascending ids, by their differences."""
    return zlib.compress(np.diff(ids, prepend=0).astype("<i8").tobytes(), 1)


def _unpack(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(blob), "<i8"))


def _shard_nodes(conv: np.ndarray, paths: list[str], words: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The nodes of a shard, depth by depth.

    Nodes that hold the first or the last row may go on in other shards: they
    are given as parts, with their ids apart, to be added up.
    """
    lens = np.fromiter((len(p) // ID_DIGITS for p in paths), np.int64, len(paths))
    ids = np.frombuffer(bytes.fromhex("".join(paths)), ">u8").astype(np.uint64).reshape(-1, 2)
    order, own = sort_shard(conv, lens, ids)
    ends_at = np.cumsum(lens)[order]
    until = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    conv, lens, own = conv[order], lens[order], own[order]
    leaf = np.r_[own[1:] <= lens[:-1], True]
    edge_paths = paths[order[0]], paths[order[-1]]
    edge_keys = [_keys(p, len(p) // ID_DIGITS) for p in edge_paths]
    at = np.arange(len(conv))
    up_first = up_least = up_edge = None
    for d in range(int(lens.max()) + 1):
        at = at[lens[at] >= d]
        first = np.flatnonzero(own[at] <= d) if d else np.zeros(1, np.int64)
        n = np.diff(np.r_[first, len(at)])
        least = np.minimum.reduceat(conv[at], first)
        all_words = until[ends_at[at]]
        begin = ends_at[at] - lens[at] - 1
        deep = max(d, 1)
        # A row of d - 1 turns does not get here, so one of d = 0 alone may have none.
        cost = np.add.reduceat(all_words - until[begin + deep], first)
        once = np.add.reduceat(all_words - until[begin + np.maximum(own[at], deep)], first)
        leaves = np.add.reduceat(leaf[at].astype(np.int64), first)
        children = np.add.reduceat(((lens[at] > d) & (own[at] <= d + 1)).astype(np.int64), first)
        ends = np.add.reduceat((lens[at] == d).astype(np.int64), first)
        edge = np.full(len(first), -1)
        if at[-1] == len(conv) - 1:
            edge[-1] = 1
        if at[0] == 0:
            edge[0] = 0
        if d:
            up = np.searchsorted(up_first, at[first], side="right") - 1
            parent, parent_edge = up_least[up], up_edge[up]
        else:
            parent, parent_edge = np.zeros(1, np.int64), np.full(1, -1)
        inner = np.flatnonzero(edge < 0)
        digests = [
            sha256(_joined(conv[at[a] : at[a] + k])).hexdigest() if k else _NO_ENDS
            for a, k in zip(first[inner].tolist(), ends[inner].tolist())
        ]
        below_edge = parent_edge[inner] >= 0
        if len(inner):
            yield _batch(
                kind=np.full(len(inner), _NODE), depth=np.full(len(inner), d), conv_id=least[inner],
                parent_key=[edge_keys[e][d - 1] if e >= 0 else None for e in parent_edge[inner].tolist()],
                parent_conv_id=pa.array(parent[inner], pa.int64(), mask=below_edge),
                n_convs=n[inner], n_children=children[inner], n_leaves=leaves[inner],
                cost=cost[inner], once=once[inner], ends_sha256=digests,
            )
        for i in np.flatnonzero(edge >= 0).tolist():
            keys = edge_keys[edge[i]]
            yield _batch(
                kind=[_PART], key=[keys[d]], parent_key=[keys[d - 1] if d else None], depth=[d],
                conv_id=[least[i]], n_convs=[n[i]], n_children=[children[i]], n_leaves=[leaves[i]],
                cost=[cost[i]], once=[once[i]],
            )
            if ends[i]:
                found = conv[at[first[i]] : at[first[i]] + ends[i]]
                yield _batch(kind=[_ENDS], key=[keys[d]], conv_id=[found[0]], ends=[_pack(found)])
        up_first, up_least, up_edge = at[first], least, edge
    told = [until[ends_at[i] - lens[i] :][: lens[i] + 1] for i in (0, -1)]
    yield _batch(
        kind=[_EDGE], conv_id=[conv[0]], path=[edge_paths[0]], words=[np.diff(told[0]).tolist()],
        last_path=[edge_paths[1]], last_words=[np.diff(told[1]).tolist()],
    )


def _batch(**columns) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    arrays = [
        pa.array(columns[name], kind) if name in columns and not isinstance(columns[name], pa.Array)
        else columns.get(name, pa.nulls(size, kind))
        for name, kind in _TYPES.items()
    ]
    return pa.RecordBatch.from_arrays(arrays, list(_TYPES))


def _shards(shard_turns: int):
    """Sorted conversations, cut into shards of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            step = min(1024, max(1, shard_turns // 8))
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                held.append(part)
                size += part.num_rows + len(part.column("words").flatten())
                if size >= shard_turns:
                    yield from _together(_shard(held))
                    held, size = [], 0
        if held:
            yield from _together(_shard(held))

    return run


def _shard(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    whole = pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
    return _shard_nodes(
        whole.column("conv_id").to_numpy(),
        whole.column("path").to_pylist(),
        whole.column("words").flatten().to_numpy(),
    )


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in fewer batches."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= 8192:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, rows = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


# --- between shards


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the parts of neighbouring shards count twice, as parts to add.

    A shard takes its first row to start every node on its path, and its last
    row to be a leaf. Of those nodes the shard before has some already, and the
    leaf may go on in the next shard.
    """
    before: tuple[str, int] | None = None
    for batch in batches:
        for row in batch.to_pylist():
            path, words = row["path"], row["words"]
            if before is not None:
                last, size = before
                both = len(commonprefix([path, last])) // ID_DIGITS
                keys = _keys(path, both)
                depths = np.arange(both + 1)
                suffix = np.r_[np.cumsum(words[:both][::-1])[::-1], 0].astype(np.int64)
                yield _batch(
                    kind=np.full(both + 1, _PART), key=keys, parent_key=[None, *keys[:-1]],
                    depth=depths, n_convs=np.zeros(both + 1, np.int64),
                    n_children=-(depths < both).astype(np.int64),
                    n_leaves=np.full(both + 1, -int(both == size)),
                    cost=np.zeros(both + 1, np.int64), once=-suffix[np.maximum(depths, 1) - 1],
                )
            before = row["last_path"], len(row["last_path"]) // ID_DIGITS


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of the ids of each key, whose packed parts come in order."""

    def told(key: bytes, state) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"key": pa.array([key], pa.binary()), "ends_sha256": [state.hexdigest()]}
        )

    now, state = None, None
    for batch in batches:
        for key, blob in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if key != now:
                if state is not None:
                    yield told(now, state)
                now, state = key, sha256()
            else:
                state.update(b",")
            state.update(_joined(_unpack(blob)))
    if state is not None:
        yield told(now, state)


def prefix_trie(turns: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Every distinct prefix of the conversations in ``turns``, as a node.

    ``turns`` has ``conv_id`` (long, one row each, not null), ``ids`` (turn ids
    of ``ID_DIGITS`` hex digits) and ``words`` (their counts), as
    :func:`sequences` gives them; other columns are not read. A conversation
    belongs to the node of each of its prefixes, from the root (no turns) to
    itself; conversations without turns belong to the root alone. No rows give
    no nodes, not even a root.

    Conversations are range-partitioned by their turns and then their id, so a
    conversation with very many copies, or a turn that very many begin with, is
    spread over shards, and each shard is sorted and summed up by itself. Nodes
    at the edges of shards, at most two paths a shard, are added up by key; what
    neighbours count twice is taken back in one pass over the shards' first and
    last rows. Ids that end at such a node meet in one task for their hash,
    packed and in order, as SHA-256 has to read them one after the other.

    Returns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for
    the root), ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes below
    or at it), ``saved_tokens`` (over it and all below: words of the last turn
    times members but one), ``ends_sha256`` (of the ids that end here).
    """
    flat = materialize(
        turns.select("conv_id", F.array_join("ids", "").alias("path"), "words"), "sequences"
    )
    # Keys are as long as conversations, so few of them are sampled for the ranges.
    with temporary_conf(flat.sparkSession, {"spark.sql.execution.rangeExchange.sampleSizePerPartition": "20"}):
        found = materialize(
            flat.repartitionByRange("path", "conv_id")
            .sortWithinPartitions("path", "conv_id")
            .mapInArrow(_shards(shard_turns), _SCHEMA),
            "trie",
        )

    def kind(wanted: int) -> DataFrame:
        return found.filter(F.col("kind") == wanted)

    # One row a shard, that is, one for ``shard_turns`` turns and rows or for a partition.
    edges = kind(_EDGE).select("conv_id", "path", "words", "last_path", "last_words")
    again = edges.repartition(1).sortWithinPartitions("path", "conv_id").mapInArrow(_meetings, _SCHEMA)
    sums = ("n_convs", "n_children", "n_leaves", "cost", "once")
    parts = (
        kind(_PART)
        .unionByName(again)
        .groupBy("key")
        .agg(
            F.max("parent_key").alias("parent_key"),
            F.max("depth").alias("depth"),
            F.min("conv_id").alias("conv_id"),
            *[F.sum(name).alias(name) for name in sums],
        )
    )
    hashes = (
        kind(_ENDS)
        .select("key", "conv_id", "ends")
        .repartition("key")
        .sortWithinPartitions("key", "conv_id")
        .mapInArrow(_hash_ends, "key binary, ends_sha256 string")
    )
    edge_nodes = materialize(
        parts.join(hashes, "key", "left").withColumn(
            "ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS))
        ),
        "edge-nodes",
    )
    own = ["parent_key", "depth", "conv_id", *sums, "ends_sha256"]
    below = F.col("parent_key").isNotNull()
    waiting = materialize(kind(_NODE).filter(below).select(own).union(edge_nodes.select(own)), "waiting")
    parents = edge_nodes.filter("n_children > 0").select(
        F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("_n")
    )
    told = attach(waiting, parents, ["parent_key"], "_n", waiting.count())
    shown = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("cost") - F.col("once")).alias("saved_tokens"), "ends_sha256",
    ]
    return kind(_NODE).filter(~below).select(shown).union(told.select(shown))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each rebuilt to share turns with its family."""
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    turns = sequences(table(spark, sf_dir, "conversations"), family=family)
    return prefix_trie(share_heads(turns))
