"""URL filters, conversation repair and vector codes against brute force on small tables with the awkward cases."""

import hashlib
import itertools
import math
import zlib

import duckdb
import numpy as np
import pytest

from crawlweave.llm import codes, queries, repair, reputation

# --- op11: URL filters -------------------------------------------------------------------------------------------

URLS = ["http://a.Example.ORG/es/x", "https://example.org/en/12?q=1", "https://example.org/en/2", "http://x.org",
        "http://x.org/", "ftp://com/de/", "https://shop.com/fr/de/", "https://shop.com/de/fr", None, "no scheme here",
        "http://badexample.org/es/", "http://h.net/a#frag/es/", "x://://b.com/fr/", "http://A.COM/FR/",
        "http://spam.example.net/p", "http://spam.example.net/q", "http://spam.example.net/r", "http://ok.example.net/",
        "https://example.org/es/", "https://example.org/es/"]


def plain_parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    cut = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    end = min([tail.index(c) for c in "?#" if c in tail] + [len(tail)])
    return host, tail[:end]


def plain_rule(host, path):
    fits = [(h, p, v) for h, p, v in reputation.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return None, None
    best = sorted(fits, key=lambda r: (-len(r[0] + r[1]), r[2] != "block", r[0] + r[1]))[0]
    return best[0] + best[1], best[2]


@pytest.fixture(scope="module")
def page_tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pages")
    pages = [(i, u, "<p>x</p>", "clash") for i, u in enumerate(URLS)] + [(None, "http://x.org/", None, None), (3, URLS[3], "", "")]
    labels = [(i, 0 if i % 3 == 0 else 1, 1 if i in (14, 15, 16) else 0, "x") for i in range(0, 20)]
    labels += [(14, 1, 1, "x"), (15, 0, 1, "x"), (2, None, None, "x"), (None, 0, 1, "x")]
    spark.createDataFrame(pages, "page_id long, url string, html string, host string").coalesce(1) \
        .write.parquet(str(folder / "pages.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int, rule string").coalesce(1) \
        .write.parquet(str(folder / "labels.parquet"))
    return str(folder)


def test_url_rules_and_parsing_against_plain_python(spark, page_tables):
    got = queries.QUERIES["op11_url_filters"](spark, page_tables).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        url = URLS[r["page_id"]] if r["page_id"] is not None and r["page_id"] < len(URLS) else (
            "http://x.org/" if r["page_id"] is None else URLS[3])
        host, path = plain_parse(url)
        assert (r["host"], r["path"]) == (host, path), url
        rule, verdict = plain_rule(host, path)
        assert r["rule"] == rule, url
        if rule:
            assert r["verdict"] == verdict
        assert r["verdict"] in ("allow", "block")


def test_url_filters_equal_their_sql(spark, page_tables):
    key = lambda r: tuple((v is None, v if v is not None else 0) for v in r)
    got = sorted((tuple(r) for r in queries.QUERIES["op11_url_filters"](spark, page_tables).collect()), key=key)
    con = duckdb.connect()
    for name in ("pages", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{page_tables}/{name}.parquet/*.parquet'")
    want = sorted((tuple(r) for r in con.sql(queries.ORACLES["op11_url_filters"]).fetchall()), key=key)
    assert got == want


def test_reputation_blocks_a_host_with_many_bad_outcomes(spark):
    pages = spark.createDataFrame([(i, f"http://{'bad' if i < 40 else 'good'}{i % 2}.example.net/x") for i in range(200)],
                                  "page_id long, url string")
    labels = spark.createDataFrame([(i, 0 if i < 40 else 1, 1 if i < 40 else 0) for i in range(200)],
                                   "doc_id long, quality int, toxic int")
    got = {r["host"]: r["verdict"] for r in reputation.judge_urls(pages, labels).collect()}
    assert got["bad0.example.net"] == got["bad1.example.net"] == "block"
    assert got["good0.example.net"] == got["good1.example.net"] == "allow"


def test_url_filters_of_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert reputation.judge_urls(pages, labels).count() == 0


# --- op12: conversation repair -------------------------------------------------------------------------------------

def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        how = zlib.crc32(key.encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if how == 0:
            continue
        if how == 1:
            text = ""
        if how == 2:
            text = "".join(c for c in text if c not in ".!?")
        if how == 4:
            role = "user"
        out += [(conv, turn, role, text, c) for c in ((0, 1) if how == 3 else (0,))]
    return out


WS = " \t\n\x0b\x0c\r"


def plain_fault(role, text, seen):
    if not text.strip(WS):
        return "b"
    if (role, text) in seen:
        return "d"
    return "t" if text.rstrip(WS)[-1] not in ".!?" else ""


def plain_repair(rows):
    """Every edit sequence with at most two inserts in a place, the cheapest and then ASCII-least."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3], r[4]))
    seen, faults = set(), []
    for r in rows:
        faults.append(plain_fault(r[2], r[3], seen))
        seen.add((r[2], r[3]))
    best, bound = [], [math.inf]

    def legal(initials):
        return re.fullmatch(r"(s?(ua)+)?", initials) is not None

    def go(i, cost, audit, out, inserted):
        if cost > bound[0]:
            return
        if i == len(rows):
            for extra in ("".join(t) for n in range(4) for t in itertools.product("ua", repeat=n)):
                roles = [r for r, _ in out] + [{"u": "user", "a": "assistant"}[c] for c in extra]
                if legal("".join(x[:1] for x in roles)):
                    lines = out + [({"u": "user", "a": "assistant"}[c], "") for c in extra]
                    best.append((cost + 2 * len(extra), audit + "I" * len(extra), lines))
                    bound[0] = min(bound[0], cost + 2 * len(extra))
            return
        if inserted < 2:
            for made in ("user", "assistant"):
                go(i, cost + 2, audit + "I", out + [(made, "")], inserted + 1)
        _, _, role, text, _ = rows[i]
        extra = 1 if faults[i] == "t" else 0
        go(i + 1, cost + 3, audit + "D", out, 0)
        if faults[i] in ("b", "d"):
            return
        go(i + 1, cost + extra, audit + "K", out + [(role, text)], 0)
        for made in ("user", "assistant"):
            go(i + 1, cost + 2 + extra, audit + "R", out + [(made, text)], 0)

    import re
    go(0, 0, "", [], 0)
    legal_ones = [b for b in best if legal("".join(r[:1] for r, _ in b[2]))]
    cost, audit, lines = min(legal_ones, key=lambda b: (b[0], b[1]))
    initials = [r[2][:1] for r in rows]
    illegal = sum(1 for a, b in zip(initials, initials[1:]) if a + b not in ("su", "ua", "au"))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = (max(turns) - min(turns) + 1 - len(set(turns))) if turns else 0
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
    return {"gaps": gaps, "blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"),
            "illegal": illegal, "cost": cost, "audit": audit, "repaired_sha256": digest}


CONVERSATIONS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "hi there"), (1, 2, "assistant", "Hello!"), (1, 3, "user", "hi there"),
    (2, 0, "assistant", "no user first."), (2, 1, "assistant", "   "), (2, 5, "user", None),
    (3, None, None, "who?"), (3, 2, "user", "a.b"), (3, 2, "user", "a.b"), (3, 4, "tool", "ran it."),
    (None, 1, "user", "null conversation?"), (None, 0, "assistant", "x."),
    (4, 0, "system", "s."), (4, 1, "system", "s2."), (4, 2, "assistant", "a."), (4, 3, "user", "u"),
]


def test_repair_against_every_edit_sequence(spark):
    rows = CONVERSATIONS + [(10 + n, t, ("user", "assistant", "system")[(n + t) % 3], f"t{t % 3}{'.' if n % 2 else ''}")
                            for n in range(40) for t in range(n % 5)]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, audit string")
    got = {r["conv_id"]: r.asDict() for r in repair.repaired_table(frame).collect()}
    after = plain_damage(rows)
    convs = {r[0] for r in rows}
    assert set(got) == convs
    for conv in convs:
        mine = [r for r in after if r[0] == conv]
        if not mine:
            want = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "",
                    "repaired_sha256": hashlib.sha256(b"").hexdigest()}
        else:
            want = plain_repair(mine)
        assert {k: got[conv][k] for k in want} == want, conv


def test_repair_backpointers_give_the_cheapest_cost():
    after = [c for c, _ in repair.END]
    costs, back = repair.step_back("assistant", "", after)
    assert back[0] == "I" and costs[0] == 2  # an empty user row, then the assistant row kept
    costs, back = repair.step_back(" ", "b", after)
    assert set(back) <= {"D", "I"}


def test_repair_of_an_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repaired_table(frame).count() == 0


# --- op13: vector codes --------------------------------------------------------------------------------------------

def test_orchard_equals_a_full_scan():
    rng = np.random.default_rng(3)
    for size, width in ((64, 4), (7, 3), (1, 2), (20, 0)):
        book = rng.integers(-5, 5, size=(size, width))
        book[size // 2:] = book[: size - size // 2]  # equal entries: ties go to the lower index
        q = rng.integers(-6, 6, size=(500, width))
        got, dist = codes.orchard(q, book, *codes.neighbour_lists(book))
        full = ((q[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
        assert (dist == full.min(axis=1)).all()
        assert (got == full.argmin(axis=1)).all()


def plain_codes(rows, parts=4, entries=5, rounds=2):
    kept = [(i, lab, [math.floor(256 * float(x)) for x in v]) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    width = len(first[0][2])
    kept = [r for r in kept if len(r[2]) == width]
    cuts = codes.bounds(width, parts)
    books = [[list(r[2][lo:hi]) for r in first] for lo, hi in cuts]

    def near(p, part):
        d = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in books[p]]
        return min(range(len(d)), key=lambda j: (d[j], j)), min(d)

    for _ in range(rounds):
        groups = [dict() for _ in cuts]
        for _, _, v in kept:
            for p, (lo, hi) in enumerate(cuts):
                groups[p].setdefault(near(p, v[lo:hi])[0], []).append(v[lo:hi])
        for p in range(parts):
            for e, members in groups[p].items():
                books[p][e] = [sum(c) // len(members) for c in zip(*members)]
    out = {}
    for i, lab, v in kept:
        found = [near(p, v[lo:hi]) for p, (lo, hi) in enumerate(cuts)]
        out.setdefault(i, []).append(("".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found), lab))
    label_error = {}
    for vals in out.values():
        for _, err, lab in vals:
            label_error[lab] = label_error.get(lab, 0) + err
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return out, label_error, digest


def test_codes_against_plain_python(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=8)], int(i % 3) if i % 7 else None) for i in range(60)]
    rows += [(None, [0.5] * 8, 1), (3, rows[3][1], rows[3][2]), (70, None, 1), (71, [float("nan")] + [0.0] * 7, 1),
             (72, [None] + [0.0] * 7, 2), (73, [1.0] * 5, 2), (74, [-0.001] * 8, None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = codes.compress_vectors(frame, parts=4, entries=5, rounds=2).collect()
    want, label_error, digest = plain_codes([(i, None if v is None else [None if x is None else float(np.float32(x))
                                                                          for x in v], lab) for i, v, lab in rows])
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["code"], r["error"]) for r in got) == sorted(
        (i is None, i or 0, c, e) for i, vals in want.items() for c, e, _ in vals)
    assert {r["codebooks_sha256"] for r in got} == {digest}
    labels = {r["vec_id"]: r["label_error"] for r in got if r["vec_id"] is not None}
    for i, vals in want.items():
        if i is not None:
            assert labels[i] == label_error[vals[0][2]]


def test_codes_of_an_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert codes.compress_vectors(frame).count() == 0
