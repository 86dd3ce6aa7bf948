"""Hierarchical Pitman-Yor language model over the bytes of words, seated by Gibbs sweeps, and text scores."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlweave.llm.common import stored
from crawlweave.llm.shingles import mix, segment_codes

GRAM, WORD = 0, 1
SPACE, END = 32, 10
CHUNK = "chunk long, doc_ids array<bigint>, ends array<bigint>, held array<boolean>, text binary, kinds binary"
REQUEST = "chunk long, kind int, code long, n long"
BLOCK = 1 << 20
SCALE = float(1 << 26)  # logarithms travel as whole numbers of this fraction


def held_out(doc_id: Column) -> Column:
    """The fold that nothing is learned from: crc32(doc_id as text) mod 7 is 2; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def plain_bytes(text: bytes | None) -> bytes:
    """Lower-cased words, each followed by a blank, then a line end: the symbols that the model sees."""
    words = text.lower().split() if text else []
    return b" ".join([*words, b"\n"])


def gram_codes(text: np.ndarray, starts: np.ndarray, order: int) -> np.ndarray:
    """For each byte the last ``order`` bytes of its text up to it as one number; line ends stand before a text."""
    padded = np.concatenate([np.full(order - 1, END, np.uint8), text])
    code = np.zeros(len(text), np.uint64)
    for k in range(order):
        code |= padded[k:k + len(text)].astype(np.uint64) << np.uint64(8 * (order - 1 - k))
    # contexts end where a text begins
    for k in range(order - 1):
        at = starts[starts + k < len(text)] + k
        seen = np.uint64((1 << 8 * (k + 1)) - 1)
        pad = sum(END << 8 * i for i in range(k + 1, order))
        inside = code[at] & seen
        code[at] = inside | np.uint64(pad)
    return code


def _totals(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    code, n = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    return code[first], np.add.reduceat(n, first)


def _counted(code: np.ndarray, learns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and how many of each learn: the flag rides in the lowest bit through one sort."""
    both = np.sort((code << np.uint64(1)) | learns.astype(np.uint64))
    code = both >> np.uint64(1)
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    return code[first], np.add.reduceat((both & np.uint64(1)).astype(np.int64), first)


def _gather(parts: list[tuple[np.ndarray, np.ndarray]], code: np.ndarray, n: np.ndarray) -> None:
    """Adds counts to ``parts``, whose first entry is what was merged so far; merges when the others outgrow it."""
    parts.append((code, n))
    if sum(len(c) for c, _ in parts[1:]) > len(parts[0][0]):
        parts[:] = [_totals(*map(list, zip(*parts)))]


def _word_codes(text: np.ndarray) -> np.ndarray:
    """63-bit hashes of the tokens: words with their blank, and line ends."""
    return segment_codes(text, (text == SPACE) | (text == END)) >> np.uint64(1)


def _stretches(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``BLOCK`` bytes."""
    first = 0
    while first < len(ends):
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + BLOCK, side="right")))
        yield first, last
        first = last


def _pack_pairs(kind: int, code: np.ndarray, n: np.ndarray) -> bytes:
    return np.array([kind, len(code)], np.int64).tobytes() + code.astype(np.int64).tobytes() + n.astype(np.int64).tobytes()


def _unpack_pairs(raw: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    at = 0
    while at < len(raw):
        kind, size = np.frombuffer(raw, np.int64, 2, at).tolist()
        yield (kind, np.frombuffer(raw, np.int64, size, at + 16), np.frombuffer(raw, np.int64, size, at + 16 + 8 * size))
        at += 16 + 16 * size


def _chunks(order: int, chunk_bytes: int):
    """Texts drawn together, with each distinct gram and word of a chunk and how often it stands in training texts."""
    def flush(number: int, ids: list, held: list, texts: list[bytes]) -> pa.RecordBatch:
        whole = b"".join(texts)
        ends = np.cumsum([len(t) for t in texts])
        text, flags = np.frombuffer(whole, np.uint8), ~np.array(held, bool)
        found = {GRAM: [], WORD: []}
        for a, b in _stretches(ends):
            low, high = (int(ends[a - 1]) if a else 0), int(ends[b - 1])
            part, stops = text[low:high], ends[a:b] - low
            starts = np.concatenate([[0], stops[:-1]]).astype(np.int64)
            learns = np.repeat(flags[a:b], stops - starts)
            tokens = np.flatnonzero((part == SPACE) | (part == END))
            for kind, code, flag in ((GRAM, gram_codes(part, starts, order), learns),
                                     (WORD, _word_codes(part), learns[tokens])):
                _gather(found[kind], *_counted(code, flag))
        squeeze = zstandard.ZstdCompressor(level=3).compress
        raw = b"".join(_pack_pairs(k, *_totals(*map(list, zip(*v)))) for k, v in found.items())
        return pa.RecordBatch.from_arrays([
            pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
            pa.array([ends.tolist()], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_())),
            pa.array([squeeze(whole)], pa.binary()), pa.array([squeeze(raw)], pa.binary())],
            ["chunk", "doc_ids", "ends", "held", "text", "kinds"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, held, texts, size = [], [], [], 0
        for batch in batches:
            for doc_id, out, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held", "text"))):
                ids.append(doc_id)
                held.append(out)
                texts.append(plain_bytes(text))
                size += len(texts[-1])
                if size >= chunk_bytes:
                    yield flush(number, ids, held, texts)
                    number, ids, held, texts, size = number + 1, [], [], [], 0
        if ids:
            yield flush(number, ids, held, texts)
    return run


def _requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk, raw in zip(batch.column("chunk").to_pylist(), batch.column("kinds").to_pylist()):
            for kind, code, n in _unpack_pairs(zstandard.ZstdDecompressor().decompress(raw)):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(code), chunk)), pa.array(np.full(len(code), kind, np.int32)), pa.array(code),
                    pa.array(n)], ["chunk", "kind", "code", "n"])


def seat(customers: np.ndarray, mass: np.ndarray, discount: float, key: np.ndarray) -> np.ndarray:
    """Tables of each dish when its customers are seated anew, one after the other, in a Chinese restaurant.

    ``mass`` is (strength + discount * tables of the restaurant) * the parent's probability of the dish. Customer n
    opens a table with probability mass / (mass + n - discount * tables). From the 17th on, customers come in parties
    of a sixteenth of those seated, whose new tables are rounded at random. Random numbers are hashes of ``key``, so a
    task that runs again seats alike.
    """
    tables = np.minimum(customers, 1)
    seated = tables.copy()
    open_rows = np.flatnonzero(customers > 1)
    step = 0
    while len(open_rows):
        n, t, a = seated[open_rows], tables[open_rows], mass[open_rows]
        party = np.minimum(np.maximum(1, n // 16), customers[open_rows] - n)
        chance = a / (a + n - discount * t)
        roll = (mix(key[open_rows] + np.uint64(step)) >> np.uint64(11)).astype(np.float64) / 2.0 ** 53
        # a party of one: floor(p + u) is 1 with probability p
        tables[open_rows] = t + np.minimum(party, np.floor(party * chance + roll).astype(np.int64))
        seated[open_rows] = n + party
        open_rows = open_rows[seated[open_rows] < customers[open_rows]]
        step += 1
    return tables


def _seat_rows(strength: float, discount: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, c, total, parent = (batch.column(n).to_numpy() for n in ("code", "c", "all_tables", "parent_p"))
            key = mix(code.view(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64)))
            t = seat(c, (strength + discount * total) * parent, discount, key)
            yield pa.RecordBatch.from_arrays([batch.column("code"), batch.column("c"), pa.array(t)], ["code", "c", "t"])
    return run


def _predict(level: int, rows: DataFrame, below: DataFrame | None, strength: float, discount: float) -> DataFrame:
    """Predictive probability of each (context, byte) of a level from its seating and the parent level's."""
    rows = rows.withColumn("context", F.shiftrightunsigned("code", 8))
    room = rows.groupBy("context").agg(F.sum("c").alias("all_customers"), F.sum("t").alias("all_tables"))
    rows = rows.join(room, "context")
    if below is None:
        rows = rows.withColumn("parent_p", F.lit(1 / 256))
    else:
        rows = rows.withColumn("parent", F.col("code").bitwiseAND(F.lit((1 << 8 * (level - 1)) - 1))).join(
            below.select(F.col("code").alias("parent"), F.col("p").alias("parent_p")), "parent")
    p = (F.col("c") - discount * F.col("t") + (strength + discount * F.col("all_tables")) * F.col("parent_p")) / (
        strength + F.col("all_customers"))
    return stored(rows.select("code", "c", "t", "all_tables", "parent_p", p.alias("p")), "hpy-level")


def _discount(rows: DataFrame) -> float:
    """From the counts of counts: n1 / (n1 + 2 n2)."""
    ones, twos = rows.agg(F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)).first()
    return min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5


def sampled_model(grams: DataFrame, order: int, burn_in: int = 1, samples: int = 2, strength: float = 1.0,
                  seed: int = 42) -> DataFrame:
    """(code, p): the averaged predictive probability of each gram, from (code, c) with counts that may be 0.

    A restaurant stands for each context; its parent is the context without its oldest byte. A sweep seats every restaurant
    anew, deepest first, given the tables and parent probabilities of the sweep before; new tables are the parent's
    customers. Then probabilities are computed from the root up. Those of the sweeps after ``burn_in`` are averaged.
    """
    def lower(rows: DataFrame, level: int, tables: str) -> DataFrame:
        mask = F.lit((1 << 8 * (level - 1)) - 1)
        return rows.groupBy(F.col("code").bitwiseAND(mask).alias("code")).agg(F.sum(tables).alias("c"))

    seats: dict[int, DataFrame] = {}
    discounts: dict[int, float] = {}
    rows = grams
    for level in range(order, 0, -1):
        seats[level] = stored(rows.select("code", "c", F.least("c", F.lit(1)).alias("t")), "hpy-seats")
        discounts[level] = _discount(seats[level])
        rows = lower(seats[level], level, "t")
    total = None
    levels: dict[int, DataFrame] = {}
    for sweep in range(burn_in + samples + 1):
        if sweep:
            rows = None
            for level in range(order, 0, -1):
                old = levels[level]
                if rows is not None:
                    old = old.drop("c").join(rows, "code")
                seats[level] = stored(old.select("code", "c", "all_tables", "parent_p").mapInArrow(
                    _seat_rows(strength, discounts[level], seed * 1000 + sweep * 100 + level),
                    "code long, c long, t long"), "hpy-seats")
                rows = lower(seats[level], level, "t")
        below = None
        for level in range(1, order + 1):
            below = levels[level] = _predict(level, seats[level], below, strength, discounts[level])
        if sweep > burn_in:
            now = below.select("code", (F.col("p") / samples).alias("p"))
            total = now if total is None else total.union(now)
    return total.groupBy("code").agg(F.sum("p").alias("p"))


class _Lookup:
    """Values of codes: one probe of a table of slots for nearly all, a binary search for the rest."""

    def __init__(self, code: np.ndarray, value: np.ndarray):
        order = np.argsort(code)
        self.code, self.value = code[order], value[order]
        self.shift = np.uint64(64 - max(4, int(4 * len(code)).bit_length()))
        self.slot = np.zeros(1 << int(64 - self.shift), np.int32)
        self.slot[self._at(self.code)] = np.arange(len(code))

    def _at(self, code: np.ndarray) -> np.ndarray:
        return ((code * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, code: np.ndarray) -> np.ndarray:
        place = self.slot[self._at(code)]
        other = np.flatnonzero(self.code[place] != code)
        place[other] = np.searchsorted(self.code, code[other])
        return self.value[place]


def _score(order: int, n_all: int, n_distinct: int):
    denominator = np.log10(n_all + 1 * (n_distinct + 1))

    def run(key, chunks: pa.Table, answers: pa.Table) -> pa.Table:
        out: dict[str, list] = {n: [] for n in ("n_tokens", "n_known", "base_score", "score")}
        ids, held = [], []
        kind = answers.column("kind").to_numpy()
        code, value = answers.column("code").to_numpy().view(np.uint64), answers.column("value").to_numpy()
        gram = _Lookup(code[kind == GRAM], value[kind == GRAM] / SCALE)
        word = _Lookup(code[kind == WORD], value[kind == WORD])
        for row in chunks.to_pylist():
            text = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["text"]), np.uint8)
            ends = np.array(row["ends"], np.int64)
            ids += row["doc_ids"]
            held += row["held"]
            for a, b in _stretches(ends):
                low, high = (int(ends[a - 1]) if a else 0), int(ends[b - 1])
                part, stops = text[low:high], ends[a:b] - low
                starts = np.concatenate([[0], stops[:-1]]).astype(np.int64)
                out["score"].append(np.add.reduceat(gram(gram_codes(part, starts, order)), starts))
                tokens = np.flatnonzero((part == SPACE) | (part == END))
                begin = np.searchsorted(tokens, starts)
                count = word(_word_codes(part))
                out["n_tokens"].append(np.diff(np.append(begin, len(tokens))))
                out["n_known"].append(np.add.reduceat((count > 0).astype(np.int64), begin))
                out["base_score"].append(np.add.reduceat(np.log10(count + 1) - denominator, begin))
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "held_out": pa.array(held, pa.bool_())} | {
            n: pa.array(np.concatenate(v) if v else np.zeros(0)).cast(pa.float64() if "score" in n else pa.int64())
            for n, v in out.items()})
    return run


def score_texts(docs: DataFrame, order: int = 6, burn_in: int = 1, samples: int = 2, chunk_bytes: int = 32 << 20,
                seed: int = 42) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every text.

    Tokens are lower-cased words and an end; a token's probability is that of its bytes (with the blank that ends a word), each
    given the ``order - 1`` bytes before it, across words. So new words have a probability too, and contexts see
    the language of the text. Counts cover all training texts. The model is a table of all grams of all texts, as large as
    they make it; it is never broadcast: texts lie in chunks, a chunk asks for its distinct grams and words only, and
    is scored where the answers meet it.

    Null texts are empty: one end. ``base_score`` is the add-one unigram. Null doc_ids are in training; repeated rows are
    texts of their own. An empty table gives no rows. Words and grams are told apart by 63-bit codes.
    """
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held"), F.col("text").cast("binary").alias("text"))
    # small splits are drawn together, so that few chunks ask for the same grams
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    rows = rows.coalesce(max(1, -(-5 * size // (4 * chunk_bytes))))
    chunks = stored(rows.mapInArrow(_chunks(order, chunk_bytes), CHUNK), "hpy-chunks")
    asked = chunks.select("chunk", "kinds").mapInArrow(_requests, REQUEST)
    counts = stored(asked.groupBy("kind", "code").agg(F.sum("n").alias("c")), "hpy-counts")
    n_all, n_distinct = counts.where(F.col("kind") == WORD).agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    model = sampled_model(counts.where(F.col("kind") == GRAM).select("code", "c"), order, burn_in, samples, seed=seed)
    values = model.select(F.lit(GRAM).alias("kind"), "code", F.round(F.log10("p") * SCALE).cast("long").alias("value")).union(
        counts.where(F.col("kind") == WORD).select("kind", "code", "c"))
    answers = asked.join(values, ["kind", "code"]).select("chunk", "kind", "code", "value")
    found = chunks.select("chunk", "doc_ids", "ends", "held", "text").groupBy("chunk").cogroup(
        answers.groupBy("chunk")).applyInArrow(_score(order, n_all, n_distinct), (
            "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"))
    return found.withColumn("train_tokens", F.lit(n_all).cast("long"))
