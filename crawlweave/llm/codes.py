"""Vector code compression: product quantisation whose nearest-entry search is Orchard's algorithm.

Vectors become integers (each component x as floor(256 * x), x as a double) and are cut into ``parts`` equal consecutive
parts (part p holds components [p * D // parts, (p + 1) * D // parts)). Each part position has a codebook, started as that
part of the ``entries`` rows with the smallest vec_ids (nulls last, equal ids by vector). Each of ``rounds`` rounds
assigns every part to its codebook's nearest entry (squared Euclidean distance, ties to the lower index) and replaces each
entry by the componentwise floor of its parts' mean (floor division, towards minus infinity); unused entries stay. Then
parts are assigned a last time.

Orchard search: for each codebook, every entry keeps the list of all entries sorted by their distance to it. A part
starts at the entry whose component sum is nearest its own; it walks the current entry's list, scores the entries not yet
visited (marked per part), and jumps to an entry that is nearer (or as near with a lower index), restarting on that
entry's list. A list is left once its next entry is more than twice as far from the current entry as the part is
(squared: more than four times): by the triangle inequality no later entry can be as near. The walk is run for a whole
Arrow batch at once; each numpy step scores the next eight entries of every row's list and jumps to the best of them.

Spark plan. The integer vectors are written once; each round is one map-only pass whose tasks sum their parts per
(part, entry) before anything leaves the task, then a grouped sum of at most parts x entries x (part width + 1) rows that
the driver collects (the codebooks, bounded by the parameters, not by the table). The codebooks travel to tasks as a
broadcast of that fixed size. ``label_error`` is a grouped sum per label joined back (the adaptive skew join splits a hot
label). Nothing grows on the driver with the table.

Defined cases: rows whose vector is null, holds a null, NaN or infinite component, or whose length differs from the first
kept row's are left out; rows with a null vec_id take part (they sort last when codebooks start) and are returned;
repeated rows each get a row; with fewer kept rows than ``entries`` the codebooks have that many entries; an empty table
gives no rows. A part of width 0 (vectors shorter than ``parts``) always takes entry 0 with distance 0.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlweave.llm.common import stored

PARTS, ENTRIES, ROUNDS = 16, 64, 2


def integer_vectors(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding",
                    label: str = "label") -> DataFrame:
    """(vec_id, label, ivec): kept rows with their vectors as floor(256 * x), written once."""
    values = F.col(vector).cast("array<double>")
    sound = ~F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    lab = F.col(label) if label in rows.columns else F.lit(None).cast("int")
    kept = rows.where(F.col(vector).isNotNull() & sound).select(
        F.col(id_column).alias("vec_id"), lab.alias("label"),
        F.transform(values, lambda x: F.floor(x * 256.0).cast("long")).alias("ivec"))
    return stored(kept, "pq-vectors")


def bounds(width: int, parts: int) -> list[tuple[int, int]]:
    return [(p * width // parts, (p + 1) * width // parts) for p in range(parts)]


def neighbour_lists(book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry, all entries by rising squared distance to it (ties to lower index), and those distances."""
    diff = book[:, None, :] - book[None, :, :]
    dist = (diff * diff).sum(axis=2)
    order = np.lexsort((np.broadcast_to(np.arange(len(book)), dist.shape), dist), axis=1)
    return order, np.take_along_axis(dist, order, axis=1)


def orchard(queries: np.ndarray, book: np.ndarray, order: np.ndarray, far: np.ndarray, step: int = 8
            ) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of the nearest entry of ``book`` for each row of ``queries``, ties to lower index.

    Each round of the walk scores the next ``step`` entries of every live row's current list at once (those within the
    bound and not yet visited) and jumps to the best improving one; a row whose list reaches the bound is done.
    """
    rows, size = len(queries), len(book)
    # start: the entry whose component sum is nearest the part's (any start is exact; a near one walks less)
    sums = book.sum(axis=1)
    by_sum = np.argsort(sums, kind="stable")
    at = np.clip(np.searchsorted(sums[by_sum], queries.sum(axis=1)), 0, size - 1)
    current = by_sum[at].astype(np.int64)
    gap = queries - book[current]
    best = (gap * gap).sum(axis=1)
    seen = np.zeros((rows, size), dtype=bool)
    seen[np.arange(rows), current] = True
    place = np.zeros(rows, dtype=np.int64)
    live = np.arange(rows)
    ahead = np.arange(step)
    while len(live):
        cur = current[live]
        spots = place[live][:, None] + ahead[None, :]
        inside = spots < size
        spots = np.minimum(spots, size - 1)
        within = inside & (far[cur[:, None], spots] <= 4 * best[live][:, None])
        ends = ~within.all(axis=1)  # the bound (or the list's end) is reached in this step
        cand = order[cur[:, None], spots]
        fresh = within & ~seen[live[:, None], cand]
        seen[live[:, None][fresh.nonzero()[0]].ravel(), cand[fresh]] = True
        gap = queries[live][:, None, :] - book[cand]
        dist = np.where(fresh, (gap * gap).sum(axis=2), np.iinfo(np.int64).max)
        # best candidate per row by (distance, index)
        key_best = np.lexsort((cand, dist), axis=1)[:, 0]
        pick = cand[np.arange(len(live)), key_best]
        pick_d = dist[np.arange(len(live)), key_best]
        better = fresh.any(axis=1) & ((pick_d < best[live]) | ((pick_d == best[live]) & (pick < cur)))
        won = live[better]
        current[won], best[won], place[won] = pick[better], pick_d[better], 0
        place[live[~better]] += step
        live = live[better | ~ends]
    return current, best


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The batch's ``ivec`` lists (all of length ``width``) as one int64 matrix, without a Python object per row."""
    values = batch.column("ivec").flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return values.reshape(batch.num_rows, width)


def _assign(books: list[np.ndarray], lists: list[tuple[np.ndarray, np.ndarray]], cuts: list[tuple[int, int]],
            vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes = np.zeros((len(vectors), len(cuts)), dtype=np.int64)
    errors = np.zeros((len(vectors), len(cuts)), dtype=np.int64)
    for p, (lo, hi) in enumerate(cuts):
        codes[:, p], errors[:, p] = orchard(vectors[:, lo:hi], books[p], *lists[p])
    return codes, errors


def _sums(shared, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, cuts = shared.value
        lists = [neighbour_lists(b) for b in books]
        sums = [np.zeros_like(b) for b in books]
        counts = [np.zeros(len(b), dtype=np.int64) for b in books]
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch, width)
            codes, _ = _assign(books, lists, cuts, vectors)
            for p, (lo, hi) in enumerate(cuts):
                np.add.at(sums[p], codes[:, p], vectors[:, lo:hi])
                counts[p] += np.bincount(codes[:, p], minlength=len(books[p]))
        out = []
        for p in range(len(books)):
            for e in np.flatnonzero(counts[p]):
                out.append((p, int(e), -1, int(counts[p][e])))
                out += [(p, int(e), j, int(v)) for j, v in enumerate(sums[p][e])]
        columns = list(zip(*out)) if out else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["part", "entry", "pos", "value"])
    return run


def hex_codes(codes: np.ndarray) -> list[str]:
    """Two lowercase hex digits per part index (indexes below 256)."""
    return [row.tobytes().hex() for row in codes.astype(np.uint8)]


def _codes(shared, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, cuts = shared.value
        lists = [neighbour_lists(b) for b in books]
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, errors = _assign(books, lists, cuts, _matrix(batch, width))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(hex_codes(codes), pa.string()),
                 pa.array(errors.sum(axis=1), pa.int64())], ["vec_id", "label", "code", "error"])
    return run


def codebooks_digest(books: list[np.ndarray]) -> str:
    """sha256 (lowercase hex) of all entries' components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(int(v)) for b in books for v in b.reshape(-1)).encode()).hexdigest()


def train_codes(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
                ) -> tuple[DataFrame, list[np.ndarray]]:
    """(codes, codebooks): codes holds vec_id, label, code (two hex digits a part), error (squared distance)."""
    if not 0 < entries <= 256:
        raise ValueError("codes are two hex digits a part: 1 to 256 entries")
    spark = rows.sparkSession
    kept = integer_vectors(rows)
    smallest = kept.orderBy(F.col("vec_id").asc_nulls_last(), "ivec").limit(1).collect()
    if not smallest:
        return spark.createDataFrame([], "vec_id long, label int, code string, error long"), []
    width = len(smallest[0]["ivec"])
    kept = kept.where(F.size("ivec") == width)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "ivec").limit(entries).collect()
    start = np.array([r["ivec"] for r in first], dtype=np.int64).reshape(len(first), width)
    cuts = bounds(width, parts)
    books = [start[:, lo:hi].copy() for lo, hi in cuts]
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((books, cuts))
        totals = (kept.select("ivec").mapInArrow(_sums(shared, width), "part long, entry long, pos long, value long")
                  .groupBy("part", "entry", "pos").agg(F.sum("value").alias("value")).collect())
        sums = [np.zeros_like(b) for b in books]
        counts = [np.zeros(len(b), dtype=np.int64) for b in books]
        for r in totals:
            if r["pos"] < 0:
                counts[r["part"]][r["entry"]] = r["value"]
            else:
                sums[r["part"]][r["entry"], r["pos"]] = r["value"]
        for p in range(parts):
            used = counts[p] > 0
            books[p][used] = np.floor_divide(sums[p][used], counts[p][used][:, None])
        shared.unpersist()
    shared = spark.sparkContext.broadcast((books, cuts))
    coded = kept.select("vec_id", "label", "ivec").mapInArrow(
        _codes(shared, width), "vec_id long, label int, code string, error long")
    return coded, books


def compress_vectors(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error (error summed over equal labels, nulls together), codebooks_sha256."""
    coded, books = train_codes(rows, parts, entries, rounds)
    coded = stored(coded, "pq-codes")
    per_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    joined = coded.join(per_label.withColumnRenamed("label", "_label"), coded["label"].eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", F.col("label_error").cast("long").alias("label_error"),
                         F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
