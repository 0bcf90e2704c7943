"""Packing documents into token sequences by certified best-fit decreasing.

Pieces fall by hash into pools that each fit a task. A pool is packed by best-fit decreasing,
and dual feasible functions give a number of sequences below which no packing of the pool
can get. Where both agree, the pool is certified. Pools with a gap give up the sequences
that are not full and exchange what is in them: all such pieces are dealt out anew, to pools
twice as large as before, and packed again. A certified pool joins in with a sequence that is
at most half full, of which it has one at most. What comes out counts if it is fewer
sequences. This ends when nothing is left to exchange, or after some rounds.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from stintlab.llm.common import map_batches
from stintlab.llm.tokens import ADDED, PieceTokens
from stintlab.staging import settle

CAPACITY = 1024
END_ID = 2
PIECES_PER_POOL = 50_000
ROUNDS = 4


def pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, serial) of every row of ``docs``.

    ``serial`` is a hash of the row's place in its task, which spreads even repeated rows.
    """

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = PieceTokens(vocabulary, ADDED)
        end = np.array([END_ID], "<u4").tobytes()
        seen = 0
        for batch in batches:
            rows: dict[str, list] = {c: [] for c in ("doc_id", "piece", "start", "length", "ids_crc32", "serial")}
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                doc_id = doc_id.as_py()
                ids = tokens.id_bytes(text.as_py() or "") + end
                n = len(ids) // 4
                # All pieces are full but the first.
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    seen += 1
                    crc = zlib.crc32(ids[4 * a : 4 * b])
                    values = (doc_id, i, a, b - a, crc, xxh64_intdigest(f"{doc_id} {seen} {crc}") >> 1)
                    for column, value in zip(rows.values(), values, strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(rows.values(), kinds, strict=True)], list(rows)
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, serial long"
    return map_batches(rows, change, schema)


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """No packing of ``lengths`` has fewer bins: the best bound of two families of dual
    feasible functions, over all their parameters."""
    counts = np.bincount(lengths, minlength=capacity + 1)
    size = np.arange(capacity + 1)
    best = -(-int((counts * size).sum()) // capacity)
    twice = 2 * size
    for small in range(capacity // 2 + 1):
        # Pieces over capacity - small count as whole bins, those under small as nothing.
        value = np.where(size > capacity - small, capacity, np.where(size < small, 0, size))
        best = max(best, -(-int((counts * value).sum()) // capacity))
    for k in range(1, 65):
        # floor((k + 1) x) / k, and x itself where (k + 1) x is whole; in units of capacity * k.
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, size * k, scaled // capacity * capacity)
        best = max(best, -(-int((counts * value).sum()) // (capacity * k)))
    for small in range(1, capacity // 2 + 1):
        # Large pieces keep what no piece of at least ``small`` can use beside them.
        kept = int(capacity // small)
        value = np.where(
            twice > capacity,
            2 * (kept - (capacity - size) // small),
            np.where(twice == capacity, kept, 2 * (size // small)),
        )
        best = max(best, -(-int((counts * value).sum()) // (2 * kept)))
    return best


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, longest first into the fullest bin it fits, and the
    fill of every bin."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    fill: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if some bin has room r
    for i in np.argsort(-lengths, kind="stable"):
        need = int(lengths[i])
        fitting = rooms >> need
        if fitting:
            room = need + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, chosen = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = chosen, fill[chosen]
        fill[chosen] += need
        by_room[room - need].append(chosen)
        rooms |= 1 << (room - need)
    return bins, offsets, np.array(fill, np.int64)


def _packed(rows: DataFrame, n_pools: int, turn: int, capacity: int) -> DataFrame:
    """Pack each pool; adds the sequence, its fill and the pool's bins and bound."""

    def change(pdf: pd.DataFrame) -> pd.DataFrame:
        # The order of rows from a shuffle is not fixed; results should be.
        pdf = pdf.sort_values(["length", "serial", "doc_id", "piece"], ascending=False)
        lengths = pdf["length"].to_numpy()
        bins, offsets, fill = best_fit(lengths, capacity)
        pool = int(pdf["pool"].iloc[0])
        return pd.DataFrame(
            {
                "row_id": pdf["row_id"].to_numpy(),
                "length": lengths,
                "serial": pdf["serial"].to_numpy(),
                "sequence_id": (turn * 2**56) + pool * 2**24 + bins,
                "offset": offsets,
                "fill": fill[bins],
                "pool": pool,
                "bins": len(fill),
                "bound": lower_bound(lengths, capacity),
            }
        )

    pool = F.pmod(F.xxhash64(F.col("serial"), F.lit(turn)), F.lit(n_pools))
    schema = (
        "row_id long, length long, serial long, sequence_id long, offset long, fill long,"
        " pool long, bins long, bound long"
    )
    return rows.withColumn("pool", pool).groupBy("pool").applyInPandas(change, schema)


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    pieces_per_pool: int = PIECES_PER_POOL,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): where it lies in which sequence.

    A document is its token ids and an end id; null and empty texts are the end id alone.
    Longer documents than ``capacity`` are cut, the first piece being the short one. A
    null doc_id is kept. Repeated rows are documents of their own. Other columns are not
    looked at. No rows give no rows. ``certified`` tells that no packing of the piece's
    pool has fewer sequences. The largest pools have ``pieces_per_pool * 2 ** rounds``
    pieces, some 100 bytes each, in one task.
    """
    cut = settle(
        pieces(docs, vocabulary, capacity).withColumn("row_id", F.monotonically_increasing_id())
    )
    rows = cut.select("row_id", "doc_id", "piece", "length", "serial")
    count = cut.count()
    done: list[DataFrame] = []
    turn = 0
    packed = settle(_packed(rows, max(1, -(-count // pieces_per_pool)), turn, capacity))
    while turn < rounds:
        gap = F.col("bins") > F.col("bound")
        loose = (gap & (F.col("fill") < capacity)) | (F.col("fill") <= capacity // 2)
        n_loose, n_bins = packed.filter(loose).agg(
            F.count("*"), F.coalesce(F.sum(F.when(F.col("offset") == 0, 1)), F.lit(0))
        ).first()
        if n_bins <= 1:
            break
        turn += 1
        again = packed.filter(loose).select("row_id", "length", "serial").withColumns(
            {"doc_id": F.col("serial"), "piece": F.lit(0)}
        )
        pools = max(1, -(-n_loose // (pieces_per_pool << turn)))
        retried = settle(_packed(again, pools, turn, capacity))
        if retried.filter(F.col("offset") == 0).count() < n_bins:
            done.append(packed.filter(~loose))
            packed = retried
    placed = packed
    for part in done:
        placed = placed.unionAll(part)
    placed = placed.select(
        "row_id", "sequence_id", "offset", (F.col("bins") == F.col("bound")).alias("certified")
    )
    return cut.join(placed, "row_id").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified"
    )
