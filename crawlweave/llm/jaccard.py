"""N-gram Jaccard join: digests of parts of the sets find candidates, prefix trees of whole sets compare them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlweave.llm.common import components, stored
from crawlweave.llm.shingles import Words, mix, sorted_sets

SOME = 512
SEEN = 1 << 16


def least_overlap(a: int, b: int, percent: int) -> int:
    """Smallest intersection with which 100 * intersection >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, a: int) -> int:
        while self.up[a] != a:
            self.up[a] = a = self.up[self.up[a]]
        return a

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


class Node:
    """A stretch of codes that all sets below share; ``sets`` end here."""

    __slots__ = ("codes", "children", "sets", "least", "most", "room")

    def __init__(self, codes: np.ndarray):
        self.codes, self.children, self.sets = codes, {}, []
        self.least = self.most = self.room = 0


class PrefixTree:
    """Sets of ascending codes, inserted one by one; ``similar`` walks it with one set and prunes by bounds.

    Of a set only its first codes may be known, then ``size`` is its whole size; codes that no other set holds may be left
    out, then ``room`` is the size without them. The walk carries the overlap so far
    and how many codes of both sets are passed. A subtree can still reach the threshold only if overlap plus the
    shorter of both remainders does, for the sizes that occur in it.
    """

    def __init__(self, percent: int):
        self.percent = percent
        self.root = Node(np.zeros(0, np.uint64))
        self.root.least = 1 << 60
        self.sizes: dict[int, tuple[int, int]] = {}

    def insert(self, name: int, codes: np.ndarray, size: int | None = None, room: int | None = None) -> None:
        node, at, end = self.root, 0, len(codes)
        size = end if size is None else size
        room = size if room is None else room
        self.sizes[name] = size, room
        while True:
            node.least, node.most, node.room = min(node.least, size), max(node.most, size), max(node.room, room)
            if at == end:
                node.sets.append(name)
                return
            child = node.children.get(codes[at])
            if child is None:
                leaf = Node(codes[at:])
                leaf.least, leaf.most, leaf.room = size, size, room
                leaf.sets.append(name)
                node.children[codes[at]] = leaf
                return
            n = min(len(child.codes), end - at)
            differ = np.flatnonzero(child.codes[:n] != codes[at:at + n])
            same = int(differ[0]) if len(differ) else n
            if same < len(child.codes):
                upper = Node(child.codes[:same])
                upper.least, upper.most, upper.room = child.least, child.most, child.room
                child.codes = child.codes[same:]
                upper.children[child.codes[0]] = child
                node.children[codes[at]] = upper
                child = upper
            node, at = child, at + same

    def similar(self, codes: np.ndarray, skip: Callable[[int], bool], size: int | None = None,
                room: int | None = None) -> Iterator[int]:
        """Names of the sets that are similar to ``codes``, or may be where only first codes are known.

        Names that ``skip`` says yes to are left out.
        """
        size, percent, end = len(codes) if size is None else size, self.percent, len(codes)
        room = size if room is None else room
        open_nodes = [(child, 0, 0, 0) for child in self.root.children.values()] if end else []
        while open_nodes:
            node, overlap, passed, at = open_nodes.pop()
            low = max(node.least, -(-percent * size // 100))
            if low > min(node.most, 100 * size // percent):
                continue
            if at < end:
                stretch = node.codes
                upto = at + int(codes[at:].searchsorted(stretch[-1], side="right"))
                mine = codes[at:upto]
                if len(mine):
                    place = mine.searchsorted(stretch)
                    overlap += int(np.count_nonzero(mine[np.minimum(place, len(mine) - 1)] == stretch))
                at = upto
                # beyond the last known code of the asking set nothing is passed
                passed += len(stretch) if at < end else int(stretch.searchsorted(codes[-1], side="right"))
            if overlap + min(room - at, node.room - passed) < least_overlap(size, low, percent):
                continue
            for name in node.sets:
                other, space = self.sizes[name]
                if overlap + min(room - at, space - passed) >= least_overlap(size, other, percent) and not skip(name):
                    yield name
            open_nodes += [(child, overlap, passed, at) for child in node.children.values()]


def shared_codes(sets: list[np.ndarray]) -> list[np.ndarray]:
    """The sets without the codes that only one of them holds."""
    codes, place, count = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_inverse=True, return_counts=True)
    keep = (count > 1)[place]
    bounds = np.cumsum([len(s) for s in sets])[:-1]
    return [s[k] for s, k in zip(sets, np.split(keep, bounds))]


def linked_sets(sets: list[np.ndarray], group: list[int], percent: int) -> list[tuple[int, int]]:
    """Links that connect what similar pairs connect, given that equal ``group`` is connected already.

    First each set is compared with leaders, sets that no earlier one matched; then, where more than one group is left,
    every set with all others of other groups. Pairs that are connected are not compared again.
    """
    union = _Union(len(sets))
    size = [len(s) for s in sets]
    sets = shared_codes(sets)
    first: dict[int, int] = {}
    for n, g in enumerate(group):
        union.join(n, first.setdefault(g, n))
    order = sorted(range(len(sets)), key=lambda n: size[n])
    links = []
    leaders = PrefixTree(percent)
    for n in order:
        matched = False
        for m in leaders.similar(sets[n], lambda m: matched and union.find(m) == union.find(n), size[n], len(sets[n])):
            matched = True
            if union.join(n, m):
                links.append((n, m))
        if not matched:
            leaders.insert(n, sets[n], size[n], len(sets[n]))
    roots = np.array([union.find(n) for n in range(len(sets))], np.int64)
    if len(sets) and (roots != roots[0]).any():
        # of two sets in different components one lies outside the largest, so only those ask
        largest = np.bincount(roots).argmax()
        tree = PrefixTree(percent)
        for n in order:
            tree.insert(n, sets[n], size[n], len(sets[n]))
        for n in order:
            if roots[n] == largest:
                continue
            for m in tree.similar(sets[n], lambda m: union.find(m) == union.find(n), size[n], len(sets[n])):
                if union.join(n, m):
                    links.append((n, m))
    return links


def stars(links: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """As many links that connect the same, each with the smallest number of its component."""
    union = _Union(n)
    for a, b in links:
        union.join(a, b)
    return [(x, union.find(x)) for x in sorted({x for link in links for x in link}) if union.find(x) != x]


def _batches(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    for whole in batches:
        for at in range(0, whole.num_rows, SOME):
            batch = whole.slice(at, SOME)
            yield batch, batch.column(text).cast(pa.binary()).to_pylist()


def most_differing(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Most codes that stand in one only of two sets of these sizes with 100 * intersection >= percent * union."""
    return (100 - percent) * (a + b) // (100 + percent)


def part_digests(sets: list[np.ndarray], percent: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(digest, set) pairs; two different similar sets of ascending hashes have at least one digest in common.

    A set is cut by value into the parts of its level (sizes from 2^level times the least size that can have a partner), and
    larger sets also into those of the lower levels in which a partner may lie. If d codes at most differ, at most d parts
    do, so in any order of the parts two similar sets share one among the first d + 1 of both. The order is by number of
    codes, most first, so that a digest stands for several codes at once: sets share it that hold all of them and
    nothing else in that part, however frequent each code is. No counts over the table are needed.
    """
    size = np.array([len(s) for s in sets], np.int64)
    if percent >= 100 or not size.sum():
        return []
    bounds = -(-percent // (100 - percent)) << np.arange(40)
    own, low = (bounds.searchsorted(s, side="right") - 1 for s in (size, -(-percent * size // 100)))
    found = []
    for step in range(int((own - low).max()) + 1):
        chosen = np.flatnonzero((own - step >= low) & (own >= step))
        if not len(chosen):
            continue
        n, level = size[chosen], own[chosen] - step
        top = bounds[level + 1] - 1
        parts = most_differing(top, 100 * top // percent, percent) * 5 // 4 + 2
        length = most_differing(n, np.minimum(n, top) if step else 100 * n // percent, percent) + 1
        code = np.concatenate([sets[c] for c in chosen])
        begin = np.cumsum(parts) - parts
        part = (code >> np.uint64(32)) * np.repeat(parts, n).astype(np.uint64) >> np.uint64(32)
        slot = np.repeat(begin, n) + part.astype(np.int64)  # ascending, as codes are
        count = np.bincount(slot, minlength=int(parts.sum()))
        first = np.flatnonzero(np.diff(slot, prepend=-1))
        sums = np.zeros(len(count), np.uint64)
        sums[slot[first]] = np.add.reduceat(mix(code), first)
        owner = np.repeat(np.arange(len(chosen)), parts)
        place = np.arange(len(count)) - begin[owner]
        digest = mix(sums + mix((level[owner] << 32 | place).astype(np.uint64)))
        order = np.lexsort((-count, owner))[place < length[owner]]
        found.append((digest[order], chosen[owner[order]]))
    return found


def _hashed(texts: list, words: int) -> list[np.ndarray]:
    """Each text's shingles as ascending 64-bit hashes."""
    code, doc = Words(texts).shingles(words)
    return sorted_sets(code, doc, len(texts))


def _names(sets: list[np.ndarray]) -> pa.Array:
    """A 64-bit digest of each set, null for the empty one."""
    return pa.array([int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)
                     if len(s) else None for s in sets], pa.int64())


def _digested(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int | None] = {None}
        for batch, texts in _batches(batches, "text"):
            sets = _hashed(texts, words)
            names = _names(sets)
            # copies that follow one another in a task need no digests of their own
            fresh = []
            for name, codes in zip(names.to_pylist(), sets):
                fresh.append(codes[:0] if name in seen else codes)
                seen.add(name)
            if len(seen) > SEEN:
                seen = {None}
            parts = part_digests(fresh, percent)
            owner = np.concatenate([np.zeros(0, np.int64), *[o for _, o in parts]])
            # 48 bits: a chance match costs one comparison
            digest = np.concatenate([np.zeros(0, np.uint64), *[d for d, _ in parts]]) >> np.uint64(16)
            ends = np.cumsum(np.bincount(owner, minlength=len(sets)))
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(
                digest[np.argsort(owner, kind="stable")].view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), names, lists],
                                             ["id", "size", "node", "digests"])
    return run


BIT_SLICES, SLICE_BITS = 1 << 10, 1 << 16


def _bits(ids: pa.Array) -> np.ndarray:
    return (mix(ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)) % np.uint64(
        BIT_SLICES * SLICE_BITS)).astype(np.int64)


def wanted_bits(wanted: DataFrame) -> np.ndarray:
    """A map of 2^26 bits, of which those of the wanted ids are set: what a scan of the texts may leave out."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = np.unique(_bits(batch.column("id")))
            yield pa.RecordBatch.from_arrays([pa.array(bit // SLICE_BITS), pa.array(bit % SLICE_BITS)], ["slice", "bit"])

    def draw(table: pa.Table) -> pa.Table:
        flags = np.zeros(SLICE_BITS, bool)
        flags[table.column("bit").to_numpy()] = True
        return pa.table({"slice": table.column("slice")[:1], "bits": pa.array([np.packbits(flags).tobytes()], pa.binary())})

    found = np.zeros((BIT_SLICES, SLICE_BITS // 8), np.uint8)
    dealt = wanted.select("id").mapInArrow(deal, "slice long, bit long").distinct()
    for row in dealt.groupBy("slice").applyInArrow(draw, "slice long, bits binary").collect():  # 8 MB at most
        found[row["slice"]] = np.frombuffer(row["bits"], np.uint8)
    return found.ravel()


def _sets(words: int, bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            bit = _bits(whole.column("id"))
            asked = np.flatnonzero((bits.value[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1)
            for batch, texts in _batches(iter([whole.take(pa.array(asked))]), "text"):
                sets = _hashed(texts, words)
                yield pa.RecordBatch.from_arrays([_names(sets), pa.array(
                    [s.tobytes() for s in sets], pa.binary())], ["node", "codes"])
    return run


LINK = "a long, b long"


def _link_group(percent: int):
    def run(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_pylist()
        table = table.take(pa.array(list({n: i for i, n in enumerate(nodes)}.values())))  # repeated ids repeat nodes
        ids, group = table.column("node").to_pylist(), table.column("component").to_pylist()
        sets = [np.frombuffer(c, np.uint64) for c in table.column("codes").to_pylist()]
        links = stars(linked_sets(sets, group, percent), len(sets))
        return pa.table({"a": pa.array([ids[x] for x, _ in links], pa.int64()),
                         "b": pa.array([ids[y] for _, y in links], pa.int64())})
    return run


def open_pairs(sizes: np.ndarray, marks: list[np.ndarray], before: list[np.ndarray], percent: int) -> np.ndarray:
    """Matrix of the pairs of rows still to judge: sizes in reach, no mark in common, no code of ``before`` in common."""
    shut = 100 * np.minimum.outer(sizes, sizes) < percent * np.maximum.outer(sizes, sizes)
    for mark in marks:
        shut |= np.equal.outer(mark, mark)
    owner = np.repeat(np.arange(len(sizes)), [len(b) for b in before])
    codes = np.concatenate([*before, np.zeros(0, np.uint64)])
    order = np.argsort(codes, kind="stable")
    codes, owner = codes[order], owner[order]
    begin = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    lengths = np.diff(np.append(begin, len(codes)))
    for n, run in enumerate(np.argsort(-lengths, kind="stable")):
        if lengths[run] < 2 or n % 16 == 0 and shut.all():
            break
        rows = owner[begin[run]:begin[run] + lengths[run]]
        shut[np.ix_(rows, rows)] = True
    return ~shut


def _hopeful(percent: int, done: list[str]):
    """Rows of a digest's group that may have a similar partner.

    Left out are partners in the same component, out of reach by size, those with which a digest of ``done`` is shared
    (they were compared in full) and pairs that share a digest in ``before``, which meet in its group.
    """
    def run(table: pa.Table) -> pa.Table:
        marks = [table.column(c).to_numpy() for c in ("component", *done)]
        before = [np.asarray(b, np.int64) for b in table.column("before").to_pylist()]
        keep = open_pairs(table.column("size").to_numpy().astype(np.int64), marks, before, percent).any(axis=1)
        return table.filter(pa.array(keep)).select(["code", "cell", "node", "id", "component"])
    return run


def _celled(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Groups of more than ``most`` rows become pairs of blocks: every two rows still meet in one cell."""
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count("*") / most).cast("int").alias("blocks"))
    sizes = sizes.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"_{k}"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = rows.join(sizes, same).withColumn("_b", block)
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.concat_ws(
        "-", F.least(o, F.col("_b")), F.greatest(o, F.col("_b"))))
    return dealt.withColumn("cell", F.explode(others)).select(*rows.columns, "cell")


def _promising(members: DataFrame, percent: int, done: list[str]) -> DataFrame:
    """Members of the digests at which a pair may meet: several components, and several digests of each kind in ``done``.

    Where a digest has two members, sizes tell whether they can reach the threshold.
    """
    bounds = members.groupBy("code").agg(
        F.count("*").alias("n"), F.min("size").alias("s"), F.max("size").alias("t"),
        F.min("component").alias("c"), F.max("component").alias("d"),
        *[f(d).alias(f"{d}_{f.__name__}") for d in done for f in (F.min, F.max)])
    several = F.col("c") != F.col("d")
    for d in done:
        several = several & (F.col(f"{d}_min") != F.col(f"{d}_max"))
    reach = (F.col("n") > 2) | (100 * F.col("s") >= percent * F.col("t"))
    return members.join(bounds.where(several & reach).select("code"), "code", "left_semi")


def _placed(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) of all nodes: by links, or alone."""
    found = components(links).withColumnRenamed("node", "_n")
    return nodes.select("node").join(found, F.col("node") == F.col("_n"), "left").select(
        "node", F.coalesce("component", "node").alias("component"))


def similar_components(docs: DataFrame, words: int = 3, percent: int = 90, most: int = 2000) -> DataFrame:
    """id, n_shingles, component for (id, text): components of documents with Jaccard of shingles >= percent / 100.

    Sets are sorted arrays of 64-bit hashes; equal sets are one node. Nodes that share a digest of a part of their sets (any
    similar pair shares one, see ``part_digests``) are candidates. Each joins the group of its smallest shared digest: a
    prefix tree of whole sets links the similar ones, and components are formed. Then each joins the group of its most
    frequent digest, which connects large groups of near copies. Last, every shared digest whose nodes lie in several
    components, smallest and frequent groups is looked at likewise. Groups above ``most`` rows
    become pairs of blocks, so that no group is held whole. Links inside what is connected are not listed. Whole sets
    are made anew from the texts that a map of 2^26 bits lets through; it only saves work, and less beyond some 10^7 of them.

    Null, empty and blank texts have no shingles and are their own components. Rows with a null id link like others,
    rows with equal ids are compared by their own texts. Component is the smallest id reachable, null if there is none. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select("id", "text")
    heads = stored(rows.mapInArrow(_digested(words, percent),
                                   "id long, size long, node long, digests array<bigint>"), "jaccard-digests")
    nodes = stored(heads.where("size > 0").groupBy("node").agg(
        F.min("id").alias("id"), F.first("size").alias("size")), "jaccard-nodes")

    same = Window.partitionBy("code")
    several = heads.select(F.explode("digests").alias("code"), "node").withColumns({
        "n": F.count("*").over(same), "least": F.min("node").over(same), "greatest": F.max("node").over(same)}).where(
        "least != greatest")
    candidates = stored(several.select("code", "node", "n").distinct(), "jaccard-shared")
    first = stored(candidates.groupBy("node").agg(
        F.min("code").alias("home"), F.max_by("code", F.struct("n", "code")).alias("hub"),
        F.collect_set("code").alias("codes")).join(nodes, "node"), "jaccard-first")

    def linked(members: DataFrame, done: list[str], once: bool) -> DataFrame:
        before = F.filter("codes", lambda c: F.lit(once) & (c < F.col("code"))).alias("before")
        slim = _promising(members, percent, done).drop("size").join(first.select("node", "id", "size", "codes"), "node").select(
            "code", "node", "id", "size", "component", *done, before)
        hopeful = stored(_celled(slim, ["code"], most).groupBy("code", "cell").applyInArrow(
            _hopeful(percent, done), "code long, cell string, node long, id long, component long"), "jaccard-hopeful")
        bits = spark.sparkContext.broadcast(wanted_bits(hopeful))
        sets = rows.mapInArrow(_sets(words, bits), "node long, codes binary")
        return stored(hopeful.select("code", "cell", "node", "component").join(sets, "node").groupBy(
            "code", "cell").applyInArrow(_link_group(percent), LINK), "jaccard-links")

    known = first.select("node", "size", "home", "hub")
    near = linked(known.withColumns({"code": F.col("home"), "component": F.col("node")}), [], False)
    placed = stored(_placed(first, near), "jaccard-placed")
    near = near.union(linked(placed.join(known, "node").withColumn("code", F.col("hub")), ["home"], False))
    placed = stored(_placed(first, near), "jaccard-placed")

    # the links that are still missing share neither smallest nor most frequent digest
    far = linked(candidates.select("code", "node").join(placed.join(known, "node"), "node"), ["home", "hub"], True)

    whole = stored(_placed(nodes, near.union(far)), "jaccard-components")
    least = nodes.join(whole, "node").groupBy("component").agg(F.min("id").alias("least"))
    of_node = whole.join(least, "component").select(F.col("node").alias("_n"), "least")
    return heads.join(of_node, F.col("node") == F.col("_n"), "left").select(
        "id", F.col("size").alias("n_shingles"), F.coalesce("least", "id").alias("component"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document: three words, similarity 0.9."""
    found = similar_components(docs.select(F.col("doc_id").alias("id"), "text"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def without_near_copies(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """One document of each component, that with the smallest doc_id, with all columns.

    Documents with a null doc_id stay (they have no identity to compare by); rows that repeat a doc_id are one document.
    """
    named = docs.where("doc_id is not null")
    found = similar_components(named.select(F.col("doc_id").alias("id"), "text"), words, percent)
    kept = found.where("id = component").select(F.col("id").alias("doc_id")).distinct()
    return named.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"]).unionByName(
        docs.where("doc_id is null"))
