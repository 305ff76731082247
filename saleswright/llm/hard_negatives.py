"""Hard negatives by rotated one-bit codes with guaranteed intervals."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saleswright.llm.common import table
from saleswright.storage import materialize

SEED = 7
#: Components become integers of this many steps a unit, within these bounds.
SCALE = 256
BOUND = 1 << 24
#: One-bit codes of a vector: each further one codes what the ones before leave.
LEVELS = 4
#: Bits of a component of an anchor, whose bit planes meet the codes.
QUERY_BITS = 6
#: Dimensions that are rotated together.
ROTATED = 256
#: Anchors of a block, on average; a block is broadcast and meets all rows.
BLOCK_ANCHORS = 1024
#: Rows that meet a block at a time, and pairs that are scored at a time.
_ROWS = 1024
_PAIRS = 1 << 16

POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 30, 90

ORACLE_SQL = f"""
WITH vecs AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM vecs a JOIN vecs b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
QUALIFY rank <= {NEGATIVES}
"""


# --- codes


def rotation(dims: int) -> np.ndarray:
    """The same random rotation for everyone who asks for so many dimensions."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, dims]).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def rotate(vectors: np.ndarray) -> np.ndarray:
    """Rotated vectors, ``ROTATED`` dimensions at a time."""
    parts = [vectors[:, a : a + ROTATED] for a in range(0, vectors.shape[1], ROTATED)]
    return np.concatenate([p @ rotation(p.shape[1]) for p in parts], axis=1)


def _packed(bits: np.ndarray) -> np.ndarray:
    """Bits as 64-bit words, last axis packed."""
    short = -bits.shape[-1] % 64
    bits = np.pad(bits, [*[(0, 0)] * (bits.ndim - 1), (0, short)])
    return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)


@dataclass
class Codes:
    """One-bit codes of vectors, with what it takes to bound inner products.

    A rotated vector is the sum over levels of its alignment with the level's
    code (the signs, as a unit vector) times that code, and a residual that is
    at right angles to the last code. ``rest`` is the residual's length and
    ``norm`` the vector's.
    """

    words: np.ndarray  # levels, rows, 64-bit words
    align: np.ndarray  # levels, rows
    rest: np.ndarray
    norm: np.ndarray

    @classmethod
    def of(cls, vectors: np.ndarray, levels: int = LEVELS) -> Codes:
        left = rotate(vectors.astype(np.float64))
        norm = np.sqrt((left * left).sum(1))
        dims = max(1, left.shape[1])
        words, align = [], []
        for _ in range(levels):
            bits = left > 0
            sign = np.where(bits, 1.0, -1.0) / np.sqrt(dims)
            along = (left * sign).sum(1)
            left = left - along[:, None] * sign
            words.append(_packed(bits))
            align.append(along)
        return cls(np.array(words), np.array(align), np.sqrt((left * left).sum(1)), norm)


@dataclass
class Queries:
    """Anchors as bit planes of their rotated components."""

    planes: np.ndarray  # bits, anchors, words
    least: np.ndarray
    step: np.ndarray
    total: np.ndarray  # sum of the rounded components
    error: np.ndarray  # length of what rounding changed
    norm: np.ndarray
    dims: int

    @classmethod
    def of(cls, vectors: np.ndarray, bits: int = QUERY_BITS) -> Queries:
        turned = rotate(vectors.astype(np.float64))
        least = turned.min(axis=1, initial=0)
        step = (turned.max(axis=1, initial=0) - least) / ((1 << bits) - 1)
        step[step == 0] = 1
        rounded = np.rint((turned - least[:, None]) / step[:, None]).astype(np.int64)
        off = turned - (least[:, None] + step[:, None] * rounded)
        planes = np.array([_packed((rounded >> b) & 1 == 1) for b in range(bits)])
        length = lambda x: np.sqrt((x * x).sum(1))
        return cls(planes, least, step, rounded.sum(1), length(off), length(turned), turned.shape[1])

    def intervals(self, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest inner product that each anchor and row may have.

        Estimates come from counts of common bits. What rounding the anchor
        changes times the coded part, and the anchor's length times the
        residual's, bound the error by Cauchy-Schwarz; the last term covers the
        rounding of this arithmetic itself.
        """
        found = np.zeros((len(self.norm), len(codes.norm)))
        for words, align in zip(codes.words, codes.align):
            ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
            common = np.zeros(found.shape)
            for b, plane in enumerate(self.planes):
                for w in range(words.shape[1]):
                    common += np.bitwise_count(plane[:, w, None] & words[None, :, w]) * float(1 << b)
            signed = self.step[:, None] * (2 * common - self.total[:, None])
            signed += self.least[:, None] * (2 * ones - self.dims)
            found += signed * (align / np.sqrt(max(1, self.dims)))
        coded = codes.norm + codes.rest
        width = self.error[:, None] * coded + self.norm[:, None] * codes.rest
        width += 1e-9 * self.norm[:, None] * codes.norm + 1e-6
        return found - width, found + width


def scores(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the pairs (a, b)."""
    found = np.empty(len(a), np.int64)
    for at in range(0, len(a), _PAIRS):
        some = slice(at, at + _PAIRS)
        found[some] = np.einsum("ij,ij->i", left[a[some]], right[b[some]])
    return found


# --- the best rows of each search


@dataclass
class Best:
    """The first rows of each of several searches, by score, then id, then place."""

    searches: int
    most: int
    found: np.ndarray = field(init=False)  # search, score, id, place

    def __post_init__(self) -> None:
        self.found = np.zeros((4, 0), np.int64)
        self.bar = np.full(self.searches, -np.inf)

    def add(self, search: np.ndarray, score: np.ndarray, ids: np.ndarray, place: np.ndarray) -> None:
        """Take rows in; ``bar`` is then the score that a search asks for at least."""
        able = score >= self.bar[search]
        if not able.any():
            return
        new = np.array([x[able] for x in (search, score, ids, place)])
        rows = np.concatenate([self.found, new], axis=1)
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        begin = np.searchsorted(rows[0], rows[0])
        rank = np.arange(rows.shape[1]) - begin
        self.found = rows[:, rank < self.most]
        full = rank == self.most - 1
        self.bar[rows[0, full]] = rows[1, full]


@dataclass
class Anchors:
    """A block of anchors and what is searched for each.

    An anchor has one search or several, each for rows of scores from ``low`` to
    ``high``; -1 fills up the searches of anchors with fewer.
    """

    place: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    search: np.ndarray
    low: np.ndarray
    high: np.ndarray
    #: Anchor id, positive id and positive's score of each search.
    names: np.ndarray


def _rows_of(part: pa.RecordBatch, dims: int) -> tuple[np.ndarray, ...]:
    """Places, ids, labels and vectors, zeros after the shorter ones."""
    lists = part.column("_vector")
    sizes = np.diff(lists.offsets.to_numpy())
    row = np.repeat(np.arange(part.num_rows), sizes)
    vectors = np.zeros((part.num_rows, dims), np.int64)
    vectors[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = lists.flatten().to_numpy()
    return (*(part.column(c).to_numpy() for c in ("_at", "_id", "_label")), vectors)


def _search(block, dims: int, same_label: bool, most: int):
    """The best rows of a partition for each search of a block of anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Anchors = block.value
        queries = Queries.of(anchors.vectors)
        best = Best(anchors.names.shape[1], most)
        ceiling = np.where(anchors.search >= 0, anchors.high, -np.inf).max(axis=1, initial=-np.inf)

        def bars() -> np.ndarray:
            """The score from which on a row may still matter to an anchor."""
            asked = np.maximum(anchors.low, best.bar[anchors.search])
            return np.where(anchors.search >= 0, asked, np.inf).min(axis=1, initial=np.inf)

        for batch in batches:
            for a in range(0, batch.num_rows, _ROWS):
                at, ids, labels, vectors = _rows_of(batch.slice(a, _ROWS), dims)
                low, high = queries.intervals(Codes.of(vectors))
                able = (anchors.labels[:, None] == labels) == same_label
                able &= anchors.place[:, None] != at
                able &= (high >= bars()[:, None]) & (low <= ceiling[:, None])
                rows, who = np.nonzero(able.T)
                for some in range(0, len(rows), _PAIRS):
                    r, w = rows[some : some + _PAIRS], who[some : some + _PAIRS]
                    # The rows before have raised the bars.
                    still = high[w, r] >= bars()[w]
                    r, w = r[still], w[still]
                    exact = scores(anchors.vectors, vectors, w, r)
                    for k in range(anchors.search.shape[1]):
                        fits = (anchors.search[w, k] >= 0) & (exact >= anchors.low[w, k]) & (exact <= anchors.high[w, k])
                        best.add(anchors.search[w[fits], k], exact[fits], ids[r[fits]], at[r[fits]])
        if best.found.shape[1]:
            columns = [*best.found, *anchors.names[:, best.found[0]]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], _FOUND)

    return run


_FOUND = ["search", "score", "id", "place", "anchor_id", "positive_id", "positive_score"]


def _best_rows(rows: DataFrame, anchors: Anchors, dims: int, same_label: bool, most: int) -> DataFrame:
    """The first ``most`` rows of each search, ranked."""
    block = rows.sparkSession.sparkContext.broadcast(anchors)
    found = rows.select("_at", "_id", "_label", "_vector").mapInArrow(
        _search(block, dims, same_label, most), ", ".join(f"{name} long" for name in _FOUND)
    )
    order = Window.partitionBy("search").orderBy(F.desc("score"), "id", "place")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def _positives(rows: DataFrame, anchors: Anchors, dims: int, most: int) -> list:
    return _best_rows(rows, anchors, dims, True, most).orderBy("search", "rank").collect()


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """For each anchor and positive, the best rows of other labels that are not too like it.

    ``anchors`` tells which rows are anchors. Ids and labels are integers. Rows
    with a null id, label, vector or component, or a component that is not
    finite, take no part. A component x becomes ``floor(SCALE * x)``, held within
    ``BOUND``; a vector shorter than the longest has zeros for the rest, an empty
    one has score zero with all. A row's score is its integer inner product with
    the anchor; higher scores come first, then smaller ids. An anchor's positives
    are its first ``positives`` other rows of the same label; its negatives for one
    are the first ``negatives`` rows of other labels whose scores lie between
    ``low`` and ``high`` hundredths of the positive's. Rows that repeat an id stand
    for themselves. No anchors give no rows.

    Blocks of about ``BLOCK_ANCHORS`` anchors are broadcast one after the other
    and meet all rows, wherever these are; a task keeps the best rows of each
    search. One-bit codes of the rotated vectors bound every score from both
    sides, and only rows whose interval can still matter are scored exactly.

    Returns ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score``, ``negative_score``.
    """
    component = f"transform(cast(`{vector_col}` as array<double>), x -> "
    unfit = F.expr(f"exists(cast(`{vector_col}` as array<double>), x -> x is null or isnan(x) or abs(x) = double('inf'))")
    whole = F.expr(component + f"cast(floor(greatest(least(x * {SCALE}, {BOUND}d), -{BOUND}d)) as int))")
    rows = vectors.filter(
        F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & ~unfit
    ).select(
        F.monotonically_increasing_id().alias("_at"),
        F.col(id_col).cast("long").alias("_id"),
        F.col(label_col).cast("long").alias("_label"),
        F.coalesce(anchors, F.lit(False)).alias("_anchor"),
        whole.alias("_vector"),
    )
    rows = materialize(rows, "vectors")
    sizes = rows.agg(F.max(F.size("_vector")).alias("dims"), F.count_if("_anchor").alias("anchors")).first()
    dims, blocks = sizes.dims or 0, -(-sizes.anchors // BLOCK_ANCHORS)
    results = []
    for block in range(blocks):
        mine = F.pmod(F.xxhash64("_at"), F.lit(blocks)) == block
        chosen = rows.filter("_anchor").filter(mine).select("_at", "_id", "_label", "_vector").toArrow()
        if not chosen.num_rows:
            continue
        at, ids, labels, found = _rows_of(chosen.combine_chunks().to_batches()[0], dims)
        n = len(ids)
        none = np.zeros(n, np.int64)
        every = Anchors(
            at, ids, labels, found, np.arange(n)[:, None], np.full((n, 1), -np.inf),
            np.full((n, 1), np.inf), np.array([ids, none, none]),
        )
        near = _positives(rows, every, dims, positives)
        if not near:
            continue
        search = np.full((n, positives), -1)
        bounds = np.zeros((2, n, positives))
        for number, row in enumerate(near):
            search[row.search, row.rank - 1] = number
            bounds[:, row.search, row.rank - 1] = (
                -(-low * row.score // 100), high * row.score // 100
            )
        names = np.array([[r.anchor_id, r.id, r.score] for r in near], np.int64).reshape(-1, 3).T
        asked = Anchors(at, ids, labels, found, search, *bounds, names)
        ranked = _best_rows(rows, asked, dims, False, negatives)
        results.append(materialize(ranked, "negatives"))
    shown = [
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    ]
    if not results:
        empty = ", ".join(f"{name} long" for name in _FOUND) + ", rank int"
        return vectors.sparkSession.createDataFrame([], empty).select(*shown)
    whole = results[0]
    for part in results[1:]:
        whole = whole.union(part)
    return whole.select(*shown)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, among all."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)
