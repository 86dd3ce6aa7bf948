"""Packing documents into sequences: shortest pack first over the histogram of lengths, joined back by rank."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlweave.llm.common import ranked, stored
from crawlweave.llm.tokens import default_tokenizer, encoded, encoder, pack_bits, unpack_bits

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


def pack_histogram(histogram: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in order) and how often each is used; ``histogram[n]`` counts the pieces of length n.

    Lengths go longest first, each into the packs that are filled least so far (the shortest), as long as they fit;
    packs that are alike are handled as one pattern with a count. Every piece gets one place.
    """
    by_fill: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(size + 1)]
    fills: list[int] = []
    for length in range(min(size, len(histogram) - 1), 0, -1):
        left = int(histogram[length])
        while left:
            while fills and not by_fill[fills[0]]:
                heapq.heappop(fills)
            fill = fills[0] if fills and fills[0] + length <= size else None
            if fill is None:
                by_fill[length].append(((length,), left))
                heapq.heappush(fills, length)
                break
            pattern, count = by_fill[fill].pop()
            used = min(count, left)
            if count > used:
                by_fill[fill].append((pattern, count - used))
            by_fill[fill + length].append(((*pattern, length), used))
            heapq.heappush(fills, fill + length)
            left -= used
    return [p for patterns in by_fill for p in patterns]


def _pieces(path: str, size: int):
    import zlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = encoder(path).bits
        for batch, rows in encoded(batches, path):
            columns: list[list] = [[] for _ in range(6)]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), rows):
                raw = memoryview(ids.astype("<u4").tobytes())
                for start in range(0, len(ids), size):
                    piece = ids[start:start + size]
                    for column, value in zip(columns, (
                            doc_id, start, len(piece), zlib.crc32(raw[4 * start:4 * (start + size)]), len(ids),
                            pack_bits(piece, bits))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.binary() if n == 5 else pa.int64()) for n, c in enumerate(columns)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])
    return run


def token_pieces(docs: DataFrame, size: int = 1024, tokenizer: str | None = None) -> DataFrame:
    """Each document's ids with the end id, cut into pieces of ``size`` and a last one of what is left, written once.

    Columns: doc_id, start, length, ids_crc32 (of the ids as little-endian 32-bit integers), doc_tokens, ids (packed in the
    fewest bits of the vocabulary, see ``unpack_bits``), piece (a number of its own).
    """
    cut = docs.select("doc_id", "text").mapInArrow(_pieces(tokenizer or default_tokenizer(), size), PIECES)
    return stored(cut.withColumn("piece", F.monotonically_increasing_id()), "pieces")


def pack_pieces(pieces: DataFrame, size: int = 1024) -> DataFrame:
    """Adds sequence_id and offset to pieces (piece, length): every piece in one sequence of at most ``size``.

    The histogram of lengths (``size`` counts) comes to the driver, where shortest-pack-first makes patterns. Pieces
    of a length stand in the order of a hash, ranked without meeting in one task; rank r of length n takes the r-th
    place for that length. The tables of patterns have at most ``size`` times the pieces of a pattern as rows.
    """
    histogram = np.zeros(size + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():
        histogram[row["length"]] = row["count"]
    places: dict[int, list[tuple[int, int, int]]] = {}  # length: (count, first sequence, offset)
    sequences = 0
    for pattern, count in pack_histogram(histogram, size):
        offset = 0
        for length in pattern:
            places.setdefault(length, []).append((count, sequences, offset))
            offset += length
        sequences += count
    tables = {n: tuple(np.array(c, np.int64) for c in zip(*rows)) for n, rows in places.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                count, first, at = tables[n]
                rows = np.flatnonzero(length == n)
                ends = np.cumsum(count)
                slot = np.searchsorted(ends, rank[rows], side="right")
                sequence[rows] = first[slot] + rank[rows] - (ends - count)[slot]
                offset[rows] = at[slot]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], [
                *batch.schema.names[:-1], "sequence_id", "offset"])

    keyed = pieces.withColumn("_key", F.xxhash64("piece"))
    rows = ranked(keyed, ["length"], ["_key", "piece"], "rank").select(*pieces.columns, "rank")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return rows.mapInArrow(place, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, size: int = 1024, tokenizer: str | None = None) -> DataFrame:
    """Pieces of all documents with their places: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, piece.

    Null text is empty: one piece with the end id alone. Null doc_ids and repeated rows are documents of their own.
    An empty table gives no rows. Offsets are gapless from 0 in each sequence. ``packed_sequences`` gives the ids.
    """
    return pack_pieces(token_pieces(docs, size, tokenizer).drop("ids"), size)


def packed_sequences(pieces: DataFrame, places: DataFrame, bits: int) -> DataFrame:
    """sequence_id, ids (array) and starts (array, where each piece begins), of ``token_pieces`` at ``places``."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [unpack_bits(d, bits, 0, n) for d, n in zip(
                batch.column("data").to_pylist(), batch.column("length").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([x.tolist() for x in ids], pa.list_(pa.int32()))],
                                             ["sequence_id", "offset", "ids"])

    whole = pieces.select("piece", "length", F.col("ids").alias("data")).join(
        places.select("piece", "sequence_id", "offset"), "piece").select("sequence_id", "offset", "length", "data")
    parts = whole.mapInArrow(unpack, "sequence_id long, offset long, ids array<int>")
    # a sequence holds at most its size in ids
    rows = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return parts.groupBy("sequence_id").agg(rows.alias("r")).select(
        "sequence_id", F.flatten(F.col("r.ids")).alias("ids"), F.col("r.offset").alias("starts"))
