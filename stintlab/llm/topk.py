"""Exact top-k inner products over an impact-ordered index, a score at a time.

Vectors are whole numbers here. Each component is taken apart into powers of two:
``x + shift`` is a sum of impacts 2**b, so that a dimension's postings fall into segments,
one per impact, and a vector stands in the segments whose impacts add up to its component.
The index is written once: a row per block of some thousand vectors, with one bit per vector
and dimension in each segment. The segments hold the vectors whole, so nothing else is stored.

Queries read the segments by descending impact. After each impact every vector's score lies
between two bounds that depend on the impacts still to come. The k-th best lower bound, or
the k-th best exact score of the blocks seen before, is what a vector must still be able to
reach. Reading stops only when so few vectors can that scoring them exactly is cheaper than
another segment; all of those are scored exactly. A vector left out is proved to have k
better ones, so results are exact.

The index stays where it is. Query blocks are written too, and each task reads them one by
one for the blocks of the index that it holds. What is shuffled is k rows per query and group of
blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stintlab.llm.common import map_batches
from stintlab.staging import new_path, settle

SCALE = 64
K = 20
# Vectors in a block of the index, queries in a block.
BLOCK = 2048
QUERY_BLOCK = 256
# Bytes of the index, taken apart, that a task holds while it reads the queries.
GROUP_BYTES = 128 * 2**20
# Scores below this are exact in doubles.
_EXACT = 2.0**53
# Rescoring a vector costs about as much as reading this many others in one segment.
_RESCORE_COST = 8
# Scores are compared in whole numbers of up to 38 digits and put out as longs.
_WIDEST = 10**38 - 1
_LONG = 2**63 - 1


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component, as whole doubles, of the vectors that
    take part."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long"), x.alias("x")).filter(
        F.col("vec_id").isNotNull()
        & F.col("x").isNotNull()
        & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    )
    return rows.select("vec_id", "x")


def _whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) in whole numbers: longs, or Python's own where longs are too short."""
    with np.errstate(over="ignore"):
        scaled = np.floor(x * scale)
    if np.abs(scaled).max(initial=0) < 2.0**62:
        return scaled.astype(np.int64)
    pairs = zip(x.flat, scaled.flat, strict=True)
    # A double whose product is beyond all doubles is whole itself.
    return np.array([int(v) if np.isfinite(v) else int(c) * scale for c, v in pairs], object).reshape(x.shape)


def _doubles(values: np.ndarray) -> np.ndarray:
    """Whole numbers as doubles; far beyond those that are exact, only their size matters."""
    if values.dtype == object:
        values = np.clip(values, -(10**150), 10**150)
    return values.astype(np.float64)


def _blocks(batches: Iterator[pa.RecordBatch], size: int, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and components of up to ``size`` rows, shorter vectors filled with zeros."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            ids = part.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64)
            lists = part.column("x")
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            out = np.zeros((len(ids), int(lengths.max(initial=0))))
            out[np.arange(out.shape[1]) < lengths[:, None]] = values
            yield ids, _whole(out, scale)


def _numbers(values: np.ndarray) -> bytes:
    """Whole numbers as longs, or as text where longs are too short."""
    if values.dtype == object:
        return b"t" + ",".join(map(str, values.flat)).encode()
    return b"l" + values.astype("<i8").tobytes()


def _parsed(stored: bytes) -> np.ndarray:
    if stored[:1] == b"l":
        return np.frombuffer(stored, "<i8", offset=1)
    return np.array([int(v) for v in stored[1:].decode().split(",")], object)


class IndexBlock:
    """Posting segments of some vectors: one 0/1 matrix per impact, greatest impact first."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.shift = vectors.min(axis=0) if len(vectors) else np.zeros(vectors.shape[1], vectors.dtype)
        lifted = vectors - self.shift
        self.planes = range(int(lifted.max(initial=0)).bit_length() - 1, -1, -1)
        self._segments = [((lifted >> plane) & 1).astype(np.float32) for plane in self.planes]

    def postings(self, plane: int) -> np.ndarray:
        return self._segments[self.planes.index(plane)]

    def stored(self) -> dict:
        """The segments, a bit each, and what a row of them needs to be read."""
        bits = [np.packbits(s.astype(bool)).tobytes() for s in self._segments]
        return {
            "n": len(self.vectors), "width": self.vectors.shape[1], "shift": _numbers(self.shift),
            "segments": bits,
        }

    @classmethod
    def read(cls, row: dict) -> IndexBlock:
        """The block of a stored row; its vectors are what their segments add up to."""
        block = cls.__new__(cls)
        n, width, bits = row["n"], row["width"], row["segments"]
        block.shift = _parsed(row["shift"])
        block.planes = range(len(bits) - 1, -1, -1)
        flat = [np.unpackbits(np.frombuffer(b, np.uint8), count=n * width).reshape(n, width) for b in bits]
        block._segments = [b.astype(np.float32) for b in flat]
        kind = object if block.shift.dtype == object or len(bits) > 62 else np.int64
        block.vectors = np.zeros((n, width), kind) + block.shift.astype(kind)
        for plane, part in zip(block.planes, flat, strict=True):
            block.vectors += part.astype(kind) << plane
        return block

    def narrowed(self, width: int) -> IndexBlock:
        """The block with its first components only."""
        if width == self.vectors.shape[1]:
            return self
        block = IndexBlock.__new__(IndexBlock)
        block.vectors, block.shift, block.planes = self.vectors[:, :width], self.shift[:width], self.planes
        block._segments = [part[:, :width] for part in self._segments]
        return block

    @property
    def held_bytes(self) -> int:
        return self.vectors.size * (8 + 4 * len(self._segments))


def _exact_scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products in whole numbers of any size."""
    return queries.astype(object) @ vectors.astype(object).T


def search_block(
    queries: np.ndarray, index: IndexBlock, k: int, reached: np.ndarray, own: np.ndarray
) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Per query the vectors of the block that may be among its k best, and their scores.

    ``reached`` holds a score per query that at least k vectors seen before have; ``own``
    marks what may not be a query's result.
    """
    n = len(index.vectors)
    wide, vectors = _doubles(queries), _doubles(index.vectors)
    # Partial scores of lifted vectors are bounded by this as well.
    largest = np.abs(wide).sum(axis=1).max(initial=0) * 2 * np.abs(vectors).max(initial=0)
    if largest >= _EXACT:
        exact = _exact_scores(queries, index.vectors)
        return [(i, np.flatnonzero(~own[i]), exact[i, ~own[i]]) for i in range(len(queries))]
    up = np.maximum(wide, 0).sum(axis=1)
    down = np.minimum(wide, 0).sum(axis=1)
    score = np.repeat((wide @ _doubles(index.shift))[:, None], n, axis=1)
    score[own] = -np.inf
    reached = np.asarray(reached, np.float64).copy()
    open_rows = np.arange(len(queries))
    found: list[tuple[int, np.ndarray, np.ndarray]] = []
    for plane in [*index.planes, -1]:
        ahead = 2.0 ** (plane + 1) - 1
        if n >= k:
            kth = np.partition(score, n - k, axis=1)[:, n - k] + ahead * down[open_rows]
            reached[open_rows] = np.maximum(reached[open_rows], kth)
        possible = score + ahead * up[open_rows][:, None] >= reached[open_rows][:, None]
        few = possible.sum(axis=1) * _RESCORE_COST <= n if plane >= 0 else np.ones(len(score), bool)
        for place in np.flatnonzero(few):
            query = open_rows[place]
            members = np.flatnonzero(possible[place] & ~own[query])
            found.append((query, members, (vectors[members] @ wide[query]).astype(np.int64)))
        open_rows, score = open_rows[~few], score[~few]
        if plane < 0 or not len(open_rows):
            break
        # float32 holds the sum of one segment's impacts exactly below 2**24.
        part = wide[open_rows].astype(np.float32) if largest < 2**24 else wide[open_rows]
        score += 2.0**plane * (part @ index.postings(plane).T)
    return found


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if scores.dtype == object:
        order = np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)
    else:
        order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _lower(score: int) -> float:
    """A double that is no greater than a score of any size."""
    if abs(score) > 10**300:
        return 1e300 if score > 0 else -np.inf
    return np.nextafter(float(score), -np.inf)


def _joined(had: np.ndarray, more: np.ndarray) -> np.ndarray:
    kind = object if object in (had.dtype, more.dtype) else np.int64
    return np.concatenate([had.astype(kind), more.astype(kind)])


def _search_group(
    group: list[tuple[np.ndarray, IndexBlock]], query_ids: np.ndarray, queries: np.ndarray, k: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Scores and ids of each query's k best vectors in some blocks of the index."""
    none = (np.empty(0, np.int64), np.empty(0, np.int64))
    best = [none] * len(queries)
    for ids, block in group:
        # What is missing in either counts as zeros, so the shorter width decides.
        width = min(queries.shape[1], block.vectors.shape[1])
        reached = np.array([_lower(int(s[k - 1])) if len(s) >= k else -np.inf for s, _ in best])
        own = query_ids[:, None] == ids
        for q, members, scores in search_block(queries[:, :width], block.narrowed(width), k, reached, own):
            had = best[q]
            best[q] = _best(_joined(had[0], scores), np.concatenate([had[1], ids[members]]), k)
    return best


def _query_blocks(path: str, size: int, scale: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first query, ids, components) of the written queries, block by block."""
    store, base = fs.FileSystem.from_uri(path if ":/" in path else f"file://{path}")
    listed = store.get_file_info(fs.FileSelector(base))
    for name in sorted(f.path for f in listed if f.base_name.startswith("part-")):
        with pq.ParquetFile(store.open_input_file(name)) as file:
            for batch in file.iter_batches(size, columns=["query_row", "vec_id", "x"]):
                numbers = batch.column("query_row").to_numpy(zero_copy_only=False)
                for ids, components in _blocks(iter([batch]), size, scale):
                    yield numbers, ids, components


def top_k(queries: DataFrame, vectors: DataFrame, k: int = K, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best inner products of each query's vector.

    Both inputs have (vec_id, embedding). No row with a query's vec_id is among its
    results. Equal scores rank by vec_id. A query with fewer than k other vectors gets all.
    Vectors that are null or hold a null, NaN or infinite component, and rows without a
    vec_id, take no part. Shorter vectors count as filled with zeros. Scores are whole numbers of
    any size; they are ranked by up to 38 digits, beyond which they count as equal, and put out
    as longs, the greatest or least one where they do not fit. A repeated query row is answered
    each time; a vec_id that vectors repeat may fill several ranks. Other columns are not
    looked at.

    Every query meets every vector, in blocks: a task holds a group of the index's blocks and reads
    the query blocks one after the other from the shared folder, which ``pyarrow.fs`` must be
    able to open. Only k rows per query and group leave it.
    """
    spark = vectors.sparkSession
    sought = new_path(spark)
    quantised(queries).withColumn("query_row", F.monotonically_increasing_id()).write.parquet(sought)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, components in _blocks(batches, BLOCK, scale):
            row = IndexBlock(components).stored() | {"ids": ids.astype("<i8").tobytes()}
            yield pa.RecordBatch.from_pylist([row], _STORED)

    stored = settle(map_batches(quantised(vectors), index, _STORED_SCHEMA))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            for numbers, query_ids, components in _query_blocks(sought, QUERY_BLOCK, scale):
                best = _search_group(group, query_ids, components, k)
                counts = [len(s) for s, _ in best]
                scores = [max(-_WIDEST, min(_WIDEST, int(v))) for s, _ in best for v in s]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(numbers, counts), pa.int64()),
                        pa.array(np.repeat(query_ids, counts), pa.int64()),
                        pa.array(np.concatenate([i for _, i in best]), pa.int64()),
                        pa.array(scores, pa.decimal128(38, 0)),
                    ],
                    ["query_row", "query_id", "vec_id", "wide"],
                )

    found = map_batches(stored, search, "query_row long, query_id long, vec_id long, wide decimal(38,0)")
    best = Window.partitionBy("query_row").orderBy(F.desc("wide"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    fitting = F.greatest(F.lit(-_LONG - 1), F.least(F.lit(_LONG), F.col("wide")))
    return ranked.select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", fitting.cast("long").alias("score")
    )


_STORED_SCHEMA = "n int, width int, shift binary, segments array<binary>, ids binary"
_STORED = pa.schema(
    [
        ("n", pa.int32()), ("width", pa.int32()), ("shift", pa.binary()),
        ("segments", pa.list_(pa.binary())), ("ids", pa.binary()),
    ]
)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[np.ndarray, IndexBlock]]]:
    """The task's blocks of the index, as many at a time as may be held."""
    group: list = []
    held = 0
    for batch in batches:
        for at in range(batch.num_rows):
            row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
            block = IndexBlock.read(row)
            group.append((np.frombuffer(row["ids"], "<i8"), block))
            held += block.held_bytes
            if held >= GROUP_BYTES:
                yield group
                group, held = [], 0
    if group:
        yield group
