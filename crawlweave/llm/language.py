"""Language ID by cross-parsing: how many phrases of each language's sample a text takes, by suffix automata."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
SEGMENT = 1024


def suffix_automaton(symbols: np.ndarray, n_symbols: int) -> np.ndarray:
    """Transitions (state, symbol) of the automaton that accepts every substring; 0, the start, where there is none."""
    states = 2 * len(symbols) + 2
    go = np.zeros((states, n_symbols), np.int32)
    link, length = [0] * states, [0] * states
    link[0] = -1
    last, made = 0, 1
    for c in symbols.tolist():
        now = made
        made += 1
        length[now] = length[last] + 1
        p = last
        while p != -1 and not go[p, c]:
            go[p, c] = now
            p = link[p]
        if p != -1:
            q = int(go[p, c])
            if length[q] == length[p] + 1:
                link[now] = q
            else:
                twin = made
                made += 1
                go[twin] = go[q]
                link[twin], length[twin] = link[q], length[p] + 1
                while p != -1 and go[p, c] == q:
                    go[p, c] = twin
                    p = link[p]
                link[q] = link[now] = twin
        last = now
    return go[:made]


def _slots(keys: np.ndarray, size: int) -> np.ndarray:
    return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - size.bit_length())).view(np.int64)


def hash_table(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys (-1 where free) and values of an open table, at most a quarter full; a taken slot leads to the next."""
    size = 1 << int(4 * len(keys) + 3).bit_length()
    kept, value = np.full(size, -1, np.int64), np.zeros(size, np.int32)
    slot, todo = _slots(keys, size), np.arange(len(keys))
    while len(todo):
        free = todo[kept[slot[todo]] < 0]
        kept[slot[free]] = keys[free]
        placed = kept[slot[todo]] == keys[todo]
        value[slot[todo[placed]]] = values[todo[placed]]
        todo = todo[~placed]
        slot[todo] = (slot[todo] + 1) & (size - 1)
    return kept, value


@dataclass
class Languages:
    """Automata of all languages in one table of the transitions there are; ``code`` maps bytes to symbols."""

    names: list[str]
    code: np.ndarray
    keys: np.ndarray  # state * symbols + symbol, the states of all languages one after the other
    targets: np.ndarray
    starts: np.ndarray
    bits: np.ndarray  # of a phrase: log2 of the length of the language's sample

    @classmethod
    def fit(cls, samples: dict[str, str]) -> Languages:
        """Texts are the UTF-8 bytes of their lower-cased form. Bytes that no sample holds share one symbol, which nothing
        matches, so no text is told apart less for it."""
        names = sorted(samples)
        texts = [_bytes(samples[k]) for k in names]
        held = np.unique(np.concatenate([*texts, np.zeros(0, np.uint8)]))
        code = np.full(256, len(held), np.uint8)  # UTF-8 has fewer than 256 different bytes
        code[held] = np.arange(len(held))
        width = len(held) + 1
        keys, targets, starts, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], 0
        for text in texts:
            table = suffix_automaton(code[text], width)
            starts.append(at)
            states = len(table)
            table = table.ravel()
            there = np.flatnonzero(table)
            keys.append(there + at * width)
            targets.append(table[there] + at)
            at += states
        bits = np.log2([max(2, len(t)) for t in texts])
        return cls(names, code, *hash_table(np.concatenate(keys), np.concatenate(targets)), np.array(starts, np.int32), bits)

    def _next(self, state: np.ndarray, symbols: np.ndarray, start: int) -> np.ndarray:
        """The states that follow, ``start`` where there is no transition."""
        wanted = state.astype(np.int64) * (int(self.code.max()) + 1) + symbols
        slot = _slots(wanted, len(self.keys))
        found = self.keys.take(slot)
        after = np.where(found == wanted, self.targets.take(slot), np.int32(start))
        todo = np.flatnonzero((found != wanted) & (found >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & (len(self.keys) - 1)
            found = self.keys[slot[todo]]
            hit = found == wanted[todo]
            after[todo[hit]] = self.targets[slot[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
        return after

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases per (text, language): the longest match with the sample and the byte after it make one.

        Texts are parsed in stretches of ``SEGMENT`` bytes, all side by side, so the work per byte is the
        same however long a text is; each stretch begins a phrase.
        """
        found = np.zeros((len(texts), len(self.names)), np.int64)
        rows = [self.code[_bytes(t)] for t in texts]
        owner = np.repeat(np.arange(len(rows)), [-(-len(r) // SEGMENT) for r in rows])
        parts = [r[i:i + SEGMENT] for r in rows for i in range(0, len(r), SEGMENT)]
        lengths = np.array([len(p) for p in parts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        block = np.zeros((SEGMENT, len(parts)), np.uint8)
        for column, n in enumerate(order):
            block[:lengths[n], column] = parts[n]
        active = np.searchsorted(-lengths[order], -np.arange(SEGMENT), side="left")  # parts longer than each step
        for k, start in enumerate(self.starts):
            state = np.full(len(parts), start, np.int32)
            count = np.zeros(len(parts), np.int32)
            for step in range(SEGMENT):
                m = active[step]
                if not m:
                    break
                now = self._next(state[:m], block[step, :m], start)
                count[:m] += now == start
                state[:m] = now
            # the phrase that the end of the text breaks off
            count += (state != start) & (lengths[order] > 0)
            np.add.at(found[:, k], owner[order], count)
        return found

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The language with the least phrases times bits, and its score: the second least's share of both."""
        cost = self.phrases(texts) * self.bits
        rows = np.arange(len(texts))
        best = np.argmin(cost, axis=1)
        least = cost[rows, best]
        rest = cost.copy()
        rest[rows, best] = np.inf
        second = rest.min(axis=1)
        with np.errstate(invalid="ignore"):
            score = np.where(np.isfinite(second), second / np.maximum(least + second, 1e-300), 1.0)
        return [self.names[b] for b in best], score


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)


def held_out(doc_id: Column) -> Column:
    """The fold that nothing is learned from: crc32(doc_id as text) mod 4 is 2; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learn_languages(docs: DataFrame, rows: int = 256, row_chars: int = 2000, chars: int = 40_000) -> Languages:
    """Fit on a bounded sample: per language ``rows`` labelled documents outside the held-out fold (those with the least
    hash), up to ``row_chars`` characters of each and ``chars`` in all (less with over 16 languages)."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    order = Window.partitionBy("lang").orderBy("h", "t")
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).withColumnRenamed("lang", "l")
    # a share of the hashes that gives four times the rows wanted, so that few are sorted
    cells = 1 << 30
    near = F.col("h") <= cells * F.least(F.lit(1.0), 4 * rows / F.col("n"))
    hashed = known.withColumn("h", F.pmod(F.xxhash64("doc_id", "text"), F.lit(cells)))
    picked = (hashed.join(counts, F.col("lang") == F.col("l")).where(near)
              .select("lang", "h", F.substring("text", 1, row_chars).alias("t"))
              .withColumn("r", F.row_number().over(order)).where(F.col("r") <= rows).orderBy("lang", "r").collect())
    samples: dict[str, list[str]] = {}
    for row in picked:
        samples.setdefault(row["lang"], []).append(row["t"])
    share = min(chars, 16 * chars // max(1, len(samples)))
    return Languages.fit({k: "\n".join(v)[:share] for k, v in samples.items()})


def identify(docs: DataFrame, text: str = "text", model: Languages | None = None) -> DataFrame:
    """Adds lang_pred and score (0 to 1) to documents, from their whole texts alone.

    ``und`` with score 0 where the text is null or has no letter, or nothing was there to learn from. Equal costs go to
    the language that is first by name. Other columns stay as they are.
    """
    model = model or learn_languages(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample: under 3 transitions a byte
    has_letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "_letters")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                rows = np.flatnonzero(batch.column("_letters").to_numpy(zero_copy_only=False)) if use.names else []
                names, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
                if len(rows):
                    found, score[rows] = use.predict(batch.column(text).take(pa.array(rows)).to_pylist())
                    for n, name in zip(rows, found):
                        names[n] = name
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in kept), pa.array(names, pa.string()), pa.array(score)],
                    [*kept, "lang_pred", "score"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    return docs.select(*kept, has_letters.alias("_letters")).mapInArrow(run, f"{kinds}, lang_pred string, score double")


def identify_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    return identify(docs.select("doc_id", "text"), model=learn_languages(docs)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def recognised(docs: DataFrame) -> DataFrame:
    """The documents that have a language, with the columns of ``docs``; a null ``lang`` takes the predicted one."""
    found = identify(docs, model=learn_languages(docs)).where(F.col("lang_pred") != UNKNOWN)
    return found.select(*[F.coalesce("lang", "lang_pred").alias("lang") if c == "lang" else F.col(c)
                          for c in docs.columns])
