"""The training-data operators against brute force on small tables with the awkward cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from crawlweave.functions.arrow import vectors
from crawlweave.llm import (chat, forest, hpylm, jaccard, language, mixing, packing, sharding, tokens, topk)
from crawlweave.llm.common import stored

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, rank string, label int"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(4000))
TEXTS = ["the cat sat on the mat", "the cat sat on the mat", "", None, "  \t\n ", "12 345 !!", LONG, LONG + " end",
         "word", "Word", "a  b \n\n c", "<|endoftext|> naïve 日本 語\x1cx", "über die brücke gehen wir",
         "the cat sat on the hat", "the cat sat on the mat"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, (None, "en", "de")[i % 3], (None, "s1", "s2", "s3")[i % 4], None, 7, "x", i)
            for i, t in enumerate(TEXTS)]
    rows += [rows[0], (None, "no id at all", "en", "s1", 1, 1, "", 1)]  # a repeated row, a null id
    return stored(spark.createDataFrame(rows, DOCS).repartition(3), "test-docs")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def test_chat_reads_back_every_turn_once(spark):
    rows = [(1, 0, "system", "be # kind <b>"), (1, 1, "user", "\\### Assistant: </turn> ok"), (1, 2, "assistant", "x\\"),
            (1, 3, "user", None), (1, 3, "user", None), (1, 4, "assistant", ""), (None, 0, None, "hi"),
            (2, None, "a:b\n\\c", "odd role"), (2, 5, "assistant", " ".join(["long"] * 3000))]
    rows += [(3, n, ("user", "assistant")[n % 2], f"turn {n} " + "word " * (n % 50)) for n in range(200)]
    table = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, window string")
    windows = chat.stored_windows(table, budget=128, history=32)
    got = {r["conv_id"]: r for r in chat.conversation_digests(windows).collect()}
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn is not None, turn or 0, role or "", text or ""))
    assert set(got) == set(by_conv)
    for conv, turns in by_conv.items():
        turns.sort()
        want = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        row = got[conv]
        assert row["n_turns"] == len(turns) and row["turns_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert row["loss_chars"] == len(loss) and row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    kept = windows.where("conv_id = 3").collect()
    assert len(kept) > 5 and all(r["n_tokens"] <= 128 for r in kept)
    # a turn above the history limit is not repeated
    assert sum(r["n_repeated"] > 0 for r in kept) > len(kept) // 3
    assert all(r["n_repeated"] >= 1 and "be " in r["text"] for r in windows.where("conv_id = 1 and window > 0").collect())
    assert chat.chat_windows(table.limit(0)).count() == 0


def test_shards_are_even_and_keep_copies_together(spark, docs, empty):
    got = sharding.shard_documents(docs, n_shards=4).toPandas()
    sizes = got.groupby("shard").size()
    assert len(got) == docs.count() and sizes.max() - sizes.min() <= 1
    assert all(sorted(g) == list(range(len(g))) for _, g in got.groupby("shard")["slot"])
    texts = dict(enumerate(TEXTS))
    for row in got.itertuples():
        if row.doc_id == row.doc_id:
            raw = (texts[int(row.doc_id)] or "").encode()
            assert row.size == len(raw) + 1 and row.text_crc32 == zlib.crc32(raw)
    assert sharding.shard_documents(empty).count() == 0
    crowd = spark.range(300).selectExpr("id as doc_id", "if(id < 120, 'same', if(id < 180, concat('p', id % 30), concat('t', id))) as text")
    placed = sharding.shard_documents(crowd, n_shards=6)
    counts = placed.groupBy("shard").count().toPandas()["count"]
    assert set(counts) == {50}
    together = placed.toPandas().groupby("link")["shard"].nunique()
    assert together.max() <= 4 and (together > 1).sum() <= 4  # the crowd of 120 needs 3 shards of 50


def vectors_table(spark, n=400):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 8))
    x[10:20] = x[10]
    x[30] = 0
    rows = [(i, [float(np.float32(v)) for v in r], 1) for i, r in enumerate(x)]
    rows[40] = (40, None, 1)
    rows[41] = (41, [None, *rows[41][1][1:]], 1)
    rows[42] = (42, [float("nan"), *rows[42][1][1:]], 1)
    rows[43] = (43, [float("inf"), *rows[43][1][1:]], 1)
    rows += [(1000, [1.0, 2.0], 1), (1050, [2.0, 1.0], 1), (1001, [1.0, 2.0], 2), (2000, [], 1), rows[100]]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int"), rows


def sound(rows):
    return {i: np.array(v, float) for i, v, _ in rows if v and all(x is not None and math.isfinite(x) for x in v)}


def nearest(vectors, score, k=5, every=50):
    return {q: sorted((-score(x, y), i) for i, y in vectors.items() if i != q and len(x) == len(y))[:k]
            for q, x in vectors.items() if q % every == 0}


def test_top_inner_products_are_exact(spark):
    table, rows = vectors_table(spark)
    got = defaultdict(list)
    for r in topk.top_inner_products(table, block_rows=64, query_rows=4).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((-r["score"], r["vec_id"]))
    want = nearest({i: np.floor(v * 256) for i, v in sound(rows).items()}, lambda x, y: int(x @ y))
    assert got == {q: v for q, v in want.items() if v}
    assert topk.top_inner_products(table.limit(0)).count() == 0
    big = spark.createDataFrame([(0, [5e6, 5e6]), (1, [5e6, 5e6 + 1]), (2, [5e6, 5e6])], "vec_id long, embedding array<double>")
    assert [(r["vec_id"], r["score"]) for r in topk.top_inner_products(big).collect()] == [
        (1, 1280000000 ** 2 + 1280000000 * 1280000256), (2, 2 * 1280000000 ** 2)]


def test_forest_recall_and_scores(spark):
    table, rows = vectors_table(spark)
    vectors = {i: v for i, v in sound(rows).items() if v.any()}
    want = nearest(vectors, lambda x, y: x @ y / math.sqrt((x @ x) * (y @ y)))
    got = forest.nearest_neighbours(table, leaf_rows=16, visits=60, query_chunk=2).collect()
    hit = sum((r["query_id"], r["vec_id"]) in {(q, i) for q, v in want.items() for _, i in v} for r in got)
    assert hit >= 0.9 * sum(map(len, want.values()))
    for r in got:
        x, y = vectors[r["query_id"]], vectors[r["vec_id"]]
        assert abs(r["score"] - x @ y / math.sqrt((x @ x) * (y @ y))) < 1e-12
    assert forest.nearest_neighbours(table.limit(0)).count() == 0


def test_mixing_meets_targets(docs, empty):
    got = mixing.mix_sources(docs).toPandas()
    sizes = defaultdict(int)
    for r in docs.collect():
        sizes[r["source"]] += len(words(r["text"]))
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > 2 * sizes[s]}
        for s in full or free:
            target[s] = 2.0 * sizes[s] if full else weight[s] * level
        left -= sum(2.0 * sizes[s] for s in full)
        free = free - full if full else set()
    assert (got["taken"] <= 2 * got["size"]).all() and len(got) == docs.count()
    for s in names:
        own = got[got["source"].isna()] if s is None else got[got["source"] == s]
        assert own["source_size"].iloc[0] == sizes[s] and abs(own["target"].iloc[0] - target[s]) < 1e-6
        assert own["taken"].sum() == math.floor(own["target"].iloc[0])
    again = mixing.mix_sources(docs.repartition(5)).toPandas()
    assert Counter(zip(got["doc_id"].fillna(-1), got["taken"])) == Counter(zip(again["doc_id"].fillna(-1), again["taken"]))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    kept = defaultdict(int)
    for r in mixed.collect():
        kept[r["source"]] += len(words(r["text"]))
    assert all(kept[s] == math.floor(target[s] + 1e-9) for s in names)
    assert mixing.mix_sources(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_mixing_sorts_no_texts_and_shares_a_cut_among_equal_rows(spark, monkeypatch):
    sorted_columns, real = [], mixing.running_sum
    monkeypatch.setattr(mixing, "running_sum", lambda rows, *rest: sorted_columns.append(rows.columns) or real(rows, *rest))
    rows = [(None, "a b c", "x")] * 5 + [(7, "d e f g", "y")] * 4 + [(8, "h", "y"), (9, None, "y"), (None, "i j", None)] + [
        (n, "k l m n o p", "z") for n in range(3)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = Counter(tuple(r) for r in mixing.mixed_documents(table, weights=(3, 2, 1), share=1.2).collect())
    assert not {"text", "_row", "_text"} & set(sum(sorted_columns, []))
    want = Counter()
    joined = mixing.mix_sources(table.withColumn("kept", F.col("text")), weights=(3, 2, 1), share=1.2)
    for r in joined.where("taken > 0").collect():
        whole, part = divmod(r["taken"], r["size"])
        want[r["doc_id"], r["kept"], r["source"]] += whole
        if part:
            want[r["doc_id"], " ".join(r["kept"].split()[:part]), r["source"]] += 1
    assert mixed == +want


@pytest.fixture(scope="module")
def plain_ids():
    from tokenizers import Tokenizer
    use = Tokenizer.from_file(tokens.default_tokenizer())
    return lambda text: [*use.encode(text or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_round_trip(spark, docs, empty, plain_ids, tmp_path):
    path = str(tmp_path / "files")
    tokens.write_token_files(docs, path, block_ids=50)  # nearly every document crosses blocks
    got = sorted(((r["doc_id"] is not None, r["doc_id"] or 0), r["start"], r["n_tokens"], r["ids_crc32"])
                 for r in tokens.token_index(spark, path).collect())
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = plain_ids(text)
        want.append(((doc_id is not None, doc_id or 0), start, len(ids), crc(ids)))
        start += len(ids)
    assert got == want
    block = tokens.BlockReader(spark.read.parquet(path).orderBy("part", "block").first()["data"])
    assert block.n_ids == 50 and block.ids(7, 9).tolist() == block.ids()[7:16].tolist()
    assert tokens.tokenized(empty).count() == 0


@pytest.mark.parametrize("bits", [1, 7, 13, 16, 17])
def test_bits_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 501)
    data = tokens.pack_bits(ids, bits)
    assert len(data) == -(-501 * bits // 8)
    assert (tokens.unpack_bits(data, bits, 0, 501) == ids).all() and (tokens.unpack_bits(data, bits, 99, 33) == ids[99:132]).all()


def test_packing_places_every_id_once(docs, empty, plain_ids):
    pieces = packing.token_pieces(docs, size=64)
    got = packing.pack_pieces(pieces.drop("ids"), size=64).toPandas()
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert own["offset"].tolist() == [0, *np.cumsum(own["length"])[:-1]] and own["length"].sum() <= 64
    want = Counter()
    for r in docs.collect():
        ids = plain_ids(r["text"])
        for a in range(0, len(ids), 64):
            want[(r["doc_id"] if r["doc_id"] is not None else -1, a, len(ids[a:a + 64]), crc(ids[a:a + 64]), len(ids))] += 1
    assert Counter(zip(got["doc_id"].fillna(-1).astype(int), got["start"], got["length"], got["ids_crc32"], got["doc_tokens"])) == want
    bits = tokens.encoder(tokens.default_tokenizer()).bits
    whole = packing.packed_sequences(pieces, docs.sparkSession.createDataFrame(got), bits).collect()
    assert sum(len(r["ids"]) for r in whole) == sum(n * k[2] for k, n in want.items())
    assert packing.pack_documents(empty).count() == 0


def test_histogram_packing_is_dense():
    counts = np.random.default_rng(1).integers(0, 50, 257)
    counts[0] = 0
    plan = packing.pack_histogram(counts, 256)
    placed = Counter()
    for pattern, n in plan:
        assert sum(pattern) <= 256 and n > 0
        for length in pattern:
            placed[length] += n
    assert [placed[n] for n in range(257)] == counts.tolist()
    used = sum(n for _, n in plan)
    assert (counts * np.arange(257)).sum() / (256 * used) > 0.97


def test_forest_recall_with_production_parameters(spark, tmp_path):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(100_000, 64)).astype(np.float32)
    pq.write_table(pa.table({"vec_id": pa.array(range(len(x)), pa.int64()), "embedding": vectors(x)}),
                   tmp_path / "embeddings.parquet")
    got = forest.nearest_neighbours(spark.read.parquet(str(tmp_path / "embeddings.parquet")).repartition(16), every=1000).collect()
    unit = x / np.sqrt((x * x).sum(1))[:, None]
    score = unit[::1000] @ unit.T
    score[np.arange(100), np.arange(0, 100_000, 1000)] = -2
    want = {(q * 1000, int(i)) for q, row in enumerate(np.argpartition(-score, 5)[:, :5]) for i in row}
    assert len(got) == 500 and len(want & {(r["query_id"], r["vec_id"]) for r in got}) >= 0.9 * 500


def test_visits_that_a_recall_needs():
    x = forest._unit(np.random.default_rng(4).normal(size=(600, 8)))
    trees = forest.grow_forest(x, 3, 16 / 600, 1)
    leaves = np.array([t.leaf_of(x) for t in trees]).T
    wanted = [np.argsort(-(x @ q))[1:6] for q in x[:40]]
    for recall in (0.5, 0.9, 1.0):
        n = forest.needed_visits(trees, x[:40], [leaves[w] for w in wanted], recall)
        shares = [np.mean([any(leaves[j, t] == leaf for t, leaf in forest.search_leaves(trees, q, v))
                           for q, w in zip(x[:40], wanted) for j in w]) for v in (n - 1, n)]
        assert shares[0] < recall <= shares[1]
    assert forest.needed_visits(trees, x[:1], [leaves[:0]], 0.9) == 0


def test_automaton_accepts_exactly_the_substrings():
    text = np.random.default_rng(2).integers(0, 3, 60)
    go = language.suffix_automaton(text, 3)
    parts = {tuple(text[a:b]) for a in range(60) for b in range(a + 1, min(60, a + 7) + 1)}
    for code in range(3 ** 6):
        probe = [code // 3 ** k % 3 for k in range(6)]
        state, known = 0, True
        for n, c in enumerate(probe):
            state = int(go[state, c]) if known else 0
            known = known and state != 0
            assert known == (tuple(probe[:n + 1]) in parts)


def test_phrases_equal_a_plain_parse():
    samples = {"a": "the quick brown fox jumps over the dog", "b": "el perro corre por la calle y el gato"}
    model = language.Languages.fit(samples)
    symbols = {k: model.code[np.minimum(np.frombuffer(v.encode("utf-32-le"), np.uint32), 0x2fff)].tobytes() for k, v in samples.items()}
    for text in ("the dog runs", "el gato", "zzz", "x" * 2500, "The quick brown fox jumps over the dog"):
        coded = model.code[np.minimum(np.frombuffer(text.lower().encode("utf-32-le"), np.uint32), 0x2fff)].tobytes()
        for k, name in enumerate(model.names):
            count = 0
            for a in range(0, len(coded), language.SEGMENT):
                part, at = coded[a:a + language.SEGMENT], 0
                while at < len(part):
                    n = 0
                    while at + n < len(part) and part[at:at + n + 1] in symbols[name]:
                        n += 1
                    at, count = at + n + 1, count + 1
            assert model.phrases([text])[0, k] == count


def test_languages_in_scripts_with_many_characters():
    rng = np.random.default_rng(3)
    scripts = {"han1": (0x4e00, 900), "han2": (0x5e00, 900), "kana": (0x3041, 80), "hangul": (0xac00, 2000), "thai": (0xe01, 50),
               "greek": (0x3b1, 24), "gothic": (0x10330, 26), "latin": (0x61, 26)}

    def text(first, many, n):
        return "".join(chr(first + c) for c in (rng.random(n) ** 3 * many).astype(int))
    model = language.Languages.fit({k: text(*v, 8000) for k, v in scripts.items()})
    texts = [(k, text(*v, 120)) for k, v in scripts.items() for _ in range(10)]
    found, score = model.predict([t for _, t in texts])
    assert found == [k for k, _ in texts] and (score > 0.5).all()


def test_languages_on_the_held_out_fold(spark, small, docs, empty):
    table = spark.read.parquet(f"{small}/documents.parquet")
    got = language.identify_languages(table).join(table.select("doc_id", "lang"), "doc_id").where("held_out")
    right, total = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert total > 20 and right > 0.9
    rows = {r["doc_id"]: r for r in language.identify_languages(docs).collect()}
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 for i in (2, 3, 4, 5))
    assert all(0 <= r["score"] <= 1 for r in rows.values()) and rows[6]["held_out"] == (zlib.crc32(b"6") % 4 == 2)
    assert language.identify_languages(empty).count() == 0
    assert {r["doc_id"] for r in language.recognised(docs).collect()} >= {0, 1, 6, None} - {2, 3, 4, 5}


def test_scores_against_counts(docs, empty):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    held = {i: zlib.crc32((str(i) if i is not None else "").encode()) % 7 == 2 for i, _ in rows}
    every = [(i, [*words(t), "\n"]) for i, t in rows]
    count = Counter(w for i, t in every if not held[i] for w in t)
    n, v = sum(count.values()), len(count)
    want = sorted((-1 if i is None else i, held[i], len(t), sum(count[w] > 0 for w in t), n,
                   round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t), 5)) for i, t in every)
    got = hpylm.score_texts(docs, order=3, chunk_bytes=20_000).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                   round(r["base_score"], 5)) for r in got) == want
    assert all(r["score"] < 0 for r in got)
    assert hpylm.score_texts(empty, order=2, samples=1).count() == 0


def test_counts_of_a_chunk_are_merged_as_they_come():
    parts, rng = [], np.random.default_rng(5)
    codes = [np.unique(rng.integers(0, 500, 400).astype(np.uint64)) for _ in range(60)]
    for code in codes:
        hpylm._gather(parts, code, np.ones(len(code), np.int64))
        assert sum(len(c) for c, _ in parts) <= 2 * 500 + len(code)
    code, n = hpylm._totals(*map(list, zip(*parts)))
    assert dict(zip(code.tolist(), n.tolist())) == Counter(np.concatenate(codes).tolist())


def test_predictive_probabilities_sum_to_one(spark):
    rng = np.random.default_rng(3)
    counts = Counter(zip(rng.integers(0, 3, 500).tolist(), rng.integers(0, 4, 500).tolist()))
    # every byte after each of three contexts, seen or not, so that the sums are complete
    rows = [((c << 8) | w, counts.get((c, w), 0)) for c in range(3) for w in range(256)]
    model = hpylm.sampled_model(spark.createDataFrame(rows, "code long, c long"), order=2)
    sums = model.groupBy(F.shiftright("code", 8)).agg(F.sum("p")).collect()
    assert len(sums) == 3 and all(abs(r[1] - 1) < 1e-9 for r in sums)


def test_seating_is_bounded_and_repeats():
    customers = np.array([0, 1, 2, 50, 100_000])
    key = np.arange(5, dtype=np.uint64)
    tables = hpylm.seat(customers, np.full(5, 0.7), 0.5, key)
    assert (tables <= customers).all() and (tables >= (customers > 0)).all()
    assert (tables == hpylm.seat(customers, np.full(5, 0.7), 0.5, key)).all()
    assert (hpylm.seat(customers, np.full(5, 1e-12), 0.0, key)[1:] == 1).all()


def brute_components(rows, percent=90):
    sets = []
    for i, t in rows:
        w = words(t)
        sets.append((i, {tuple(w[k:k + 3]) for k in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())))
    up = {i: i for i, _ in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in sets)


@pytest.mark.parametrize("most", [2000, 3])
def test_components_equal_all_pairs(spark, docs, empty, most):
    rng = np.random.default_rng(9)
    base = [[f"v{x}" for x in rng.integers(0, 400, n)] for n in (80, 120, 60)]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] is not None]
    common = "this line is in very many of the texts here "
    for n in range(90):
        own = list(base[n % 3])
        for at in rng.integers(0, len(own), n % 4):
            own[at] = f"edit{n}{at}"
        rows.append((100 + n, (common if n % 2 else "") + " ".join(own)))
    rows += [(300 + n, common + common + f"tail {n % 7}") for n in range(30)]
    table = spark.createDataFrame(rows, "id long, text string").repartition(3)
    got = jaccard.similar_components(table, most=most).collect()
    assert sorted((r["id"], r["n_shingles"], r["component"]) for r in got) == brute_components(rows)
    kept = jaccard.without_near_copies(docs)
    assert kept.columns == docs.columns and kept.where("doc_id in (0, 1, 14)").count() == 1
    assert jaccard.jaccard_components(empty).count() == 0


def test_components_on_the_given_documents(spark, small):
    table = spark.read.parquet(f"{small}/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    got = jaccard.similar_components(table).collect()
    want = brute_components([(r["id"], r["text"]) for r in table.collect()])
    assert sorted((r["id"], r["n_shingles"], r["component"]) for r in got) == want


def test_pipeline_stages(spark, docs, plain_ids):
    now = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, now, ""), name)
        assert after.columns == now.columns and 0 < after.count()
        now = after
    texts = [r["text"] for r in now.collect()]
    assert not any(t is None or not t.strip() for t in texts)
    packed = corpus_pipeline.STAGES[-1][1](spark, now, "")
    assert packed.agg(F.sum("length")).first()[0] == sum(len(plain_ids(t)) for t in texts)


def test_large_group_of_near_copies_against_brute_force(spark):
    rng = random.Random(5)
    base = [f"w{n}" for n in range(120)]
    rows = []
    for n in range(60):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((n, " ".join(words)))
    rows += [(100 + n, " ".join([f"y{n}-{k}" for k in range(80)] + base[:60])) for n in range(20)]
    sets = {i: {tuple(t.split()[k:k + 3]) for k in range(len(t.split()) - 2)} for i, t in rows}
    up = {i: i for i in sets}
    alike = [(a, b) for a in sets for b in sets if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    for _ in rows:
        for a, b in alike:
            up[a] = up[b] = min(up[a], up[b])
    table = spark.createDataFrame(rows, "id long, text string")
    for most in (2000, 16):
        got = jaccard.similar_components(table, most=most).collect()
        assert {r["id"]: r["component"] for r in got} == up
        assert {r["id"]: r["n_shingles"] for r in got} == {i: len(s) for i, s in sets.items()}


def test_a_text_links_with_itself_and_words_of_its_own(spark):
    """The longer text's own shingles come first in its head, so most of the shorter one's head lies beyond it."""
    text = " ".join(f"w{i}" for i in range(92))
    more = text + " " + " ".join(f"x{i}" for i in range(10))  # 90 of 100 shingles
    rows = [(2, text), (1, more), (None, text + " y"), (4, more + " z"), (5, text + " " + more)]
    got = jaccard.similar_components(spark.createDataFrame(rows, "id long, text string")).collect()
    assert sorted((r["n_shingles"], r["component"]) for r in got) == [
        (90, 1), (91, 1), (100, 1), (101, 1), (102, 1)]


def test_similar_sets_share_a_digest_and_others_with_common_codes_do_not():
    """Candidates come from what sets hold together, not from how rare a code is, so they do not multiply with the table."""
    rng = np.random.default_rng(12)
    for percent in (90, 80, 50):
        for _ in range(300):
            a = int(np.exp(rng.uniform(0, 6)))
            b = int(rng.integers(a, 100 * a // percent + 1))
            both = min(a, jaccard.least_overlap(a, b, percent))
            codes = rng.integers(0, 1 << 64, a + b - both, dtype=np.uint64)
            pair = [np.sort(codes[:a]), np.sort(np.concatenate([codes[:both], codes[a:]]))]
            found = jaccard.part_digests(pair, percent)
            mine, theirs = ({d for digests, sets in found for d, s in zip(digests.tolist(), sets) if s == n} for n in (0, 1))
            assert both == b or mine & theirs
    common = rng.integers(0, 1 << 64, 300, dtype=np.uint64)
    sets = [np.sort(np.concatenate([common, rng.integers(0, 1 << 64, 300, dtype=np.uint64)])) for _ in range(200)]
    digests = np.concatenate([d for d, _ in jaccard.part_digests(sets, 90)])
    _, times = np.unique(digests, return_counts=True)
    assert times[times > 1].sum() < 0.05 * len(digests)


def test_stars_connect_the_same():
    assert jaccard.stars([(1, 2), (2, 3), (5, 4), (6, 6)], 7) == [(2, 1), (3, 1), (5, 4)]
    assert jaccard.stars([], 3) == []
    assert [list(s) for s in jaccard.shared_codes([np.array([1, 2], np.uint64), np.array([2, 3], np.uint64),
                                                   np.array([], np.uint64)])] == [[2], [2], []]


def test_near_copy_stage_against_brute_force_at_five_words(spark):
    rng = random.Random(8)
    rows = []
    for n in range(12):
        base = [f"b{n}x{k}" for k in range(100)]
        for edits in range(6):
            own = list(base)
            for at in rng.sample(range(5, 95, 6), edits):
                own[at] = f"e{n}x{edits}x{at}"
            rows.append((len(rows), " ".join(own)))
    sets = [{tuple(t.split()[k:k + 5]) for k in range(96)} for _, t in rows]
    near = [[100 * len(a & b) >= 80 * len(a | b) for b in sets] for a in sets]
    least = list(range(len(rows)))
    for _ in rows:
        least = [min(least[m] for m in range(len(rows)) if near[n][m]) for n in range(len(rows))]
    table = spark.createDataFrame([(*r, "en", "s", 1) for r in rows],
                                  "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = dict(corpus_pipeline.STAGES)["near_copies"](spark, table, "").collect()
    assert sorted(r["doc_id"] for r in got) == sorted(set(least)) and len(set(least)) == 48
