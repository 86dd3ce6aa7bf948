"""Token ids by a public tokenizer, and a file format that keeps each id in the fewest bits of the vocabulary."""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crawlweave.llm.common import stored
from crawlweave.session import scratch_path

END_ID = 0
BLOCK_IDS = 1 << 16


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


#: Fixed value: the split before the merges of byte-level BPE, for texts of Latin letters (others: see PieceEncoder).
_LETTERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_DIGITS = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
SPLIT = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[{_DIGITS}]+| ?[^\s{_LETTERS}{_DIGITS}]+|\s+(?!\S)|\s+")
#: Beyond these characters the split depends on Unicode tables.
_OTHER = "[^\t-\r -~\xa0-\u024f\u2010-\u2027]"


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it prints, else the next one from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class _Places(dict):
    """Numbers pieces in order of first sight; ``new`` lists those not encoded yet."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        place = self[piece] = len(self)
        self.new.append(piece)
        return place


class PieceEncoder:
    """Ids of whole texts by a byte-level BPE of the tokenizers library, each distinct piece encoded once.

    Merges never cross the pieces into which byte-level BPE splits a text. Texts of Latin letters are split here and
    each new piece goes to the library's model; texts with other characters or with one of the file's added tokens go
    to the library whole, as do all texts if the file is of another kind. Pieces are remembered up to ``most`` of
    them, then forgotten.
    """

    def __init__(self, path: str, most: int = 700_000):
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        kind = str(self.tokenizer.pre_tokenizer)
        simple = (kind.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in kind
                  and self.tokenizer.normalizer is None and self.tokenizer.post_processor is None)
        self.whole = re.compile("|".join([_OTHER, *added]) if simple else "").search
        self.bits = max(1, (self.tokenizer.get_vocab_size() - 1).bit_length())
        self.letters = dict(enumerate(_byte_letters()))
        self.most = most
        self._forget()

    def _forget(self) -> None:
        self.places = _Places()
        self.ids = np.zeros(1 << 16, np.int32)
        self.first = np.zeros(1, np.int64)

    def _learn(self) -> None:
        rows = [[t.id for t in self.tokenize(p.encode().decode("latin-1").translate(self.letters))]
                for p in self.places.new]
        self.places.new.clear()
        used = self.first[-1]
        ends = used + np.cumsum([len(r) for r in rows])
        while len(self.ids) < ends[-1]:
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[used:ends[-1]] = np.fromiter(chain.from_iterable(rows), np.int32, ends[-1] - used)
        self.first = np.concatenate([self.first, ends])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each); null is empty."""
        if len(self.places) > self.most:
            self._forget()
        place = self.places.__getitem__
        rows: list[int] = []
        at = []
        for n, text in enumerate(texts.to_pylist()):
            if text and self.whole(text):
                rows.append(n)
                text = None
            own = SPLIT.findall(text) if text else ()
            at.append(np.fromiter(map(place, own), np.int64, len(own)))
        if self.places.new:
            self._learn()
        counts = np.cumsum([len(x) for x in at])
        at = np.concatenate(at) if at else np.zeros(0, np.int64)
        lengths = self.first[at + 1] - self.first[at]
        ends = np.cumsum(lengths)
        ids = self.ids[np.repeat(self.first[at] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]
        sizes = np.diff(np.concatenate([[0], ends])[np.concatenate([[0], counts]).astype(np.int64)])
        return self._with_whole(texts, np.array(rows), ids, sizes) if rows else (ids, sizes)

    def _with_whole(self, texts: pa.Array, rows: np.ndarray, ids: np.ndarray,
                    sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts.take(pa.array(rows)).to_pylist(), add_special_tokens=False)
        parts = np.split(ids, np.cumsum(sizes)[:-1])
        for n, e in zip(rows, found):
            parts[n] = np.array(e.ids, np.int32)
        return np.concatenate(parts), np.array([len(x) for x in parts], np.int64)


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """One encoder per worker process and vocabulary; its memory of pieces outlives a task."""
    return PieceEncoder(path)


def encoded(batches: Iterator[pa.RecordBatch], path: str, end_id: int = END_ID,
            some: int = 256) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Batches of a few rows with the ids of their ``text``, each ending in ``end_id``."""
    use = encoder(path)
    for whole in batches:
        for at in range(0, whole.num_rows, some):
            batch = whole.slice(at, some)
            ids, counts = use.encode(batch.column("text"))
            cuts = np.cumsum(counts)
            ids = np.insert(ids, cuts, end_id)
            yield batch, np.split(ids, (cuts + np.arange(1, len(cuts) + 1))[:-1])


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Each id in ``bits`` bits, most significant first, the last byte filled with zeros."""
    if bits == 16:
        return ids.astype(">u2").tobytes()
    shifts = np.arange(bits - 1, -1, -1, dtype=np.uint32)
    return np.packbits(((ids.astype(np.uint32)[:, None] >> shifts) & 1).astype(np.uint8)).tobytes()


def unpack_bits(data: bytes | memoryview, bits: int, start: int, count: int) -> np.ndarray:
    """``count`` ids from position ``start``: only the bytes that hold them are touched."""
    if bits == 16:
        return np.frombuffer(data, ">u2", count, start * 2).astype(np.uint32)
    low, high = start * bits, (start + count) * bits
    near = np.unpackbits(np.frombuffer(data, np.uint8, -(-high // 8) - low // 8, low // 8))
    cells = near[low % 8:low % 8 + count * bits].reshape(count, bits).astype(np.uint32)
    return cells @ (np.uint32(1) << np.arange(bits - 1, -1, -1, dtype=np.uint32))


#: The head of a block. Magic, bits, number of pieces, number of ids, first id's place in the file.
HEAD = struct.Struct("<4sIIQQ")
MAGIC = b"TIB1"


class BlockReader:
    """One block: head, then per piece doc_id, its place in its document and its end in the block, then packed ids."""

    def __init__(self, block: bytes):
        magic, self.bits, pieces, self.n_ids, self.first = HEAD.unpack_from(block)
        if magic != MAGIC:
            raise ValueError("not a block of packed ids")
        table = np.frombuffer(block, np.int64, pieces * 4, HEAD.size).reshape(pieces, 4)
        self.doc_null, self.doc_id, self.place, self.ends = table[:, 0] != 0, table[:, 1], table[:, 2], table[:, 3]
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.data = memoryview(block)[HEAD.size + pieces * 32:]

    def ids(self, start: int = 0, count: int | None = None) -> np.ndarray:
        """Any run of the block's ids."""
        return unpack_bits(self.data, self.bits, start, self.n_ids - start if count is None else count)

    def piece(self, n: int) -> np.ndarray:
        return self.ids(int(self.starts[n]), int(self.ends[n] - self.starts[n]))


def _block(parts: list[tuple[int | None, int, np.ndarray]], bits: int, first: int) -> bytes:
    table = np.array([(d is None, d or 0, place, 0) for d, place, _ in parts], np.int64).reshape(-1, 4)
    table[:, 3] = np.cumsum([len(x) for _, _, x in parts])
    ids = np.concatenate([x for _, _, x in parts])
    return HEAD.pack(MAGIC, bits, len(parts), len(ids), first) + table.tobytes() + pack_bits(ids, bits)


def _write(path: str, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, first, parts, held = 0, 0, [], 0
        bits = encoder(path).bits
        part_no = TaskContext.get().partitionId()

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in (
                (part_no, pa.int32()), (number, pa.int32()), (first, pa.int64()), (held, pa.int64()),
                (_block(parts, bits, first), pa.binary()))], ["part", "block", "first", "n_ids", "data"])

        for batch, rows in encoded(batches, path):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), rows):
                place = 0
                while place < len(ids):
                    piece = ids[place:place + block_ids - held]
                    parts.append((doc_id, place, piece))
                    place, held = place + len(piece), held + len(piece)
                    if held == block_ids:
                        yield flush()
                        number, first, parts, held = number + 1, first + held, [], 0
        if held:
            yield flush()
    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, block_ids: int = BLOCK_IDS) -> None:
    """Write the ids of all texts in ascending doc_id order below ``path``, each document ended by id 0.

    A file holds one range of doc_ids: rows (part, block, first, n_ids, data), ``data`` being a block of at most
    ``block_ids`` ids in the fewest bits that hold the vocabulary, with its documents' offsets; ``first`` counts the
    ids before it in the file. Parquet only carries the blocks, so any store that Spark writes to will do; they read
    without Spark through ``BlockReader``. A document may cross blocks. Null text is empty (the end id alone); null doc_ids
    come first; rows with equal doc_ids are documents of their own, ordered by a hash of the text.
    """
    tokenizer = tokenizer or default_tokenizer()
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    (rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
     .mapInArrow(_write(tokenizer, block_ids), "part int, block int, first long, n_ids long, data binary")
     .write.option("compression", "zstd").parquet(path))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of documents from blocks: an id's crc runs on over the blocks that a document crosses."""
    for batch in batches:
        for part, number, data in zip(*(batch.column(c).to_pylist() for c in ("part", "block", "data"))):
            block = BlockReader(data)
            ids = block.ids().astype("<u4")
            raw = memoryview(ids.tobytes())
            spans = zip(block.starts.tolist(), block.ends.tolist())
            whole = [raw[4 * a:4 * b] for a, b in spans]
            last = len(whole) - 1
            crosses = [n == 0 and block.place[0] > 0 or n == last and (not ids.size or ids[-1] != END_ID)
                       for n in range(len(whole))]
            yield pa.RecordBatch.from_arrays([
                pa.array([part] * len(whole), pa.int32()), pa.array([number] * len(whole), pa.int32()),
                pa.array(np.where(block.doc_null, None, block.doc_id).tolist(), pa.int64()), pa.array(block.place),
                pa.array(block.first + block.starts), pa.array(block.ends - block.starts),
                pa.array([zlib.crc32(x) for x in whole], pa.int64()),
                pa.array([bytes(x) if c else None for x, c in zip(whole, crosses)], pa.binary())],
                ["part", "block", "doc_id", "place", "at", "n", "crc", "raw"])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Pieces of the documents in token files: part, block, doc_id, place (ids of the document before the piece), at
    (ids of the file before it), n, crc (of the ids as little-endian 32-bit integers), raw (those bytes where a document may cross blocks)."""
    blocks = spark.read.schema("part int, block int, first long, n_ids long, data binary").parquet(path)
    return blocks.select("part", "block", "data").mapInArrow(
        _read, "part int, block int, doc_id long, place long, at long, n long, crc long, raw binary")


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of each document, from the files."""
    pieces = stored(read_token_files(spark, path), "token-pieces")
    parts = pieces.groupBy("part").agg(F.sum("n").alias("ids"))  # one row a file
    base = parts.select(F.col("part").alias("p"), F.coalesce(F.sum("ids").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    # a document is the stretch of pieces between two that begin one: it is named by where it begins
    begin = (F.col("at") - F.col("place")).alias("begin")
    whole = pieces.select("part", "doc_id", begin, "at", "n", "crc", "raw")
    crossing = F.array_sort(F.collect_list(F.when(F.col("raw").isNotNull(), F.struct("at", "raw"))))
    joined = F.aggregate(crossing, F.lit(b"").cast("binary"), lambda a, r: F.concat(a, r["raw"]))
    docs = whole.groupBy("part", "begin", "doc_id").agg(
        F.sum("n").alias("n_tokens"), F.count("*").alias("pieces"), F.max("crc").alias("crc"), joined.alias("bytes"))
    return docs.join(base, F.col("part") == F.col("p")).select(
        "doc_id", (F.col("base") + F.col("begin")).alias("start"), "n_tokens",
        F.when(F.col("pieces") == 1, F.col("crc")).otherwise(F.crc32("bytes")).alias("ids_crc32"))


def tokenized(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the token files of ``docs`` below the shared folder, read them back: the index of ``token_index``."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer)
    return token_index(docs.sparkSession, path)
