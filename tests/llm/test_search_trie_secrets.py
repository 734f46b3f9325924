"""Operators 11 to 13 against plain versions of their rules."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from clearspan.llm import credentials, lexical, registry, trie

FOLDER = "/root/testdata/sf0.01"
NAMES = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]


# ---------------------------------------------------------------- operator 11


def base(text):
    """(start, kind number, end) by the plain patterns."""
    text, out = text or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        out += [(m.start(), 0, m.end())] if len(m[2]) >= 8 else []
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        out += [(m.start(), 1, m.end())] if len(m[0]) >= 16 else []
    for m in re.finditer("[0-9a-f]+", text):
        out += [(m.start(), 2, m.end())] if len(m[0]) >= 32 else []
    return sorted(out)


def digest(spans):
    return ",".join(f"{credentials.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_base_spans_of_all_documents(spark):
    texts = dict(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    rows = credentials.op11_secret_spans(spark, FOLDER).select(NAMES).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    assert any(r.n_assign for r in rows) and any(r.n_hex for r in rows)
    for r in rows:
        spans = base(texts[r.doc_id])
        counts = Counter(k for _, k, _ in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(counts[k] for k in range(3))
        assert r.base_sha256 == hashlib.sha256(digest(spans).encode()).hexdigest()
        assert digest(spans) in r.spans or not spans


def test_secrets_of_odd_rows(spark, docs, no_docs):
    """Nulls, empty texts, equal rows, letters beyond ASCII, short and long values, contexts of every form."""
    hard = "xK9#qL2$vR!u"
    texts = [
        None, "", f"é password is {hard} next", f"PASSWORD = '{hard}'", "password: letmein", "pwd: qwertyuiop", f"see ftp://me:{hard}@host/x",
        f"Authorization: Bearer {'aZ3'.join('q8Rw')}", f"<secret>{hard}</secret>", "password=short", "password=" + "x" * 8, "AKIA" + "A" * 11, "AKIA" + "A" * 12,
        "0" * 31, "0" * 32 + "G" + "f" * 40, "tokſen = abcdefghij", "paſſword=abcdefghij", "api_Key\": \"abcdefgh", f"passphrase := \"{hard} {hard}\"",
        "token = " + "Zq7" * 30000, f"password: {hard}, password: {hard}",
    ]
    rows = [(k, t, "kept", "x") for k, t in enumerate(texts)] + [(3, texts[3], "kept", "x"), (None, texts[3], None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, secrets string, kind string")
    got = credentials.with_secrets(frame.repartition(3))
    assert got.columns == ["doc_id", "text", "kind", "secrets"] and got.count() == len(rows)
    for r in got.collect():
        plain = [(s.start, credentials.KINDS.index(s.kind), s.end) for s in r.secrets]
        assert [s for s in plain if s[1] < 3] == base(r.text) and plain == sorted(plain)
        guessed = [(r.text[s.start : s.end], s.guesses) for s in r.secrets if s.kind == "guess"]
        assert all(g >= credentials.LEAST_GUESSES for _, g in guessed)
        if r.doc_id in (2, 3, 6, 8):
            assert [t for t, _ in guessed] == [hard]
        if r.doc_id == 20:
            assert [t for t, _ in guessed] == [f"{hard},", hard]
        if r.doc_id == 18:
            assert [t for t, _ in guessed] == [f"{hard} {hard}"]
        if r.doc_id in (0, 1, 4, 5, 9, 13, 15):
            assert not r.secrets
        if r.doc_id == 7:
            assert len(guessed) == 1
        # a value inside a pattern match is no span of its own
        assert not (r.doc_id in (10, 17, 19) and guessed)
    assert credentials.with_secrets(docs).count() == docs.count()
    assert credentials.with_secrets(no_docs).count() == 0


def test_cheapest_cut_by_all_cuts():
    """The programme finds what trying all cuts finds, on short values."""
    guess = credentials.Guesser({"pass": 10, "word": 20, "cat": 300, "password": 2})
    seg = guess.SEGMENT

    def pieces(v, i, j):
        plain = v.lower()
        leet = "".join(credentials._LEET.get(c, c) for c in plain)
        yield sum(guess.brute(c) for c in v[i:j])
        for e, c in (*guess.words(v, plain, leet, i), *guess.dates(v, i), *guess.walks(plain, i)):
            if e == j:
                yield c
        for p in range(1, min(guess.UNIT, j - i - 1) + 1):
            times = (j - i) // p
            # the longest run of a unit from its start, as in the programme
            if times >= 2 and (j - i) % p == 0 and j - i >= 3 and v[i:j] == v[i : i + p] * times and v[i : i + p] != v[j : j + p]:
                yield guess.cost(v[i : i + p], repeats=False) + math.log10(times)

    def slow(v):
        best = math.inf
        for n in range(len(v)):
            for cuts in itertools.combinations(range(1, len(v)), n):
                edges = [0, *cuts, len(v)]
                best = min(best, sum(seg + min(pieces(v, a, b)) for a, b in itertools.pairwise(edges)))
        return best

    for v in ["password", "P4ssword", "catcat", "aaaa", "qwe12", "cat1999", "xyzabc", "pa$$cat", "31121999", "9a!Bq", "é0é0é", "Zq7Zq7"]:
        assert guess.cost(v) == pytest.approx(slow(v)), v
    assert guess.cost("") == 0


# ---------------------------------------------------------------- operator 12


def ranking(docs, items, k):
    """The contract by dictionaries."""
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    bags = [(i, Counter(cut(t))) for i, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n_docs, every = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(cut(t))
    out = []
    for i, terms in wanted.items():
        scores = []
        for (d, bag), n in zip(bags, sizes, strict=True):
            if n:
                m = 100 - 50 + (50 * n * n_docs) // every
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m)) for t in terms if bag[t])
                scores += [(-s, d is None, d or 0, d)] if s > 0 else []
        out += [(i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("part", [lexical.PART_ENTRIES, 3])
def test_search_of_odd_rows(spark, part):
    """Ties, equal rows, null ids and texts, items without terms, letters beyond ASCII, several parts of items."""
    rng = random.Random(5)
    words = ["Alpha", "beta", "GAMMA", "delta9", "é", "ét", "ÄB", "x_y", "the"]
    docs = [(k, " ".join(rng.choices(words, k=rng.randint(0, 12)))) for k in range(150)]
    docs += [(7, docs[7][1]), (200, None), (None, "beta beta"), (201, ""), (202, "!? \t--"), (203, "the " * 5000)] + [(300 + k, "gamma x é") for k in range(30)]
    items = [(1, "alpha BETA alpha"), (2, "x-y é"), (3, None), (4, ""), (5, "absent"), (6, "the"), (1, "delta9"), (None, "gamma"), (8, "é ét äb ÄB")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: trie.F.lit(1) for c in ("score", "rank", "n")})
    q = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in lexical.search(d.repartition(4), q, 20, part=part).collect()), key=str)
    assert got == ranking(docs, items, 20)
    assert lexical.search(d.limit(0), q).count() == 0 and lexical.search(d, q.limit(0)).count() == 0
    assert lexical.search(d, q).columns == ["item_id", "rank", "doc_id", "score"]


def test_tiles_stay_exact_and_keep_ties():
    """Tiles narrower than an item add up; the bound of 2^53 sets their width; ties at the k-th score survive."""
    weight = np.full(50, 40_000, np.int64)
    tiles = lexical.Tiles(np.zeros(50, np.int64), np.arange(50), weight)
    assert tiles.width * 40_000 * lexical.MOST_IMPACT < lexical.EXACT
    tiles = lexical.Tiles(np.zeros(50, np.int64), np.arange(50), np.full(50, 1 << 32, np.int64))
    assert tiles.width == 1
    (first, scores), = tiles.scores(np.zeros(50, np.int64), np.arange(50), np.full(50, 999_999), 1)
    assert first == 0 and scores[0, 0] == 50 * (1 << 32) * 999_999
    row, column = lexical._best(np.array([[5, 9, 5, 5, 0], [0, 0, 0, 0, 0]]), np.array([4, 3, 2, 1, 0]), 3)
    assert row.tolist() == [0, 0, 0] and column.tolist() == [1, 3, 2]


# ---------------------------------------------------------------- operator 13


def plain_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    seqs = {}
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 6
        seqs[c] = turns.get(c - int(math.fmod(c, 100)), [])[:h] + turns[c][h:]
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p in sorted(members, key=len, reverse=True):
        leaves[p] += not kids[p]
        saved[p] += (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        if p:
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in m if len(seqs[c]) == len(p))
        out.append((m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = "conv_id long, turn long, role string, text string, depth string, name string"


def conversations(rng, longest):
    rows = [(None, 1, "u", "x"), (5, None, "u", "a"), (5, 1, None, None), (5, 1, None, None), (5, 1, "a", "b"), (7, 3, "u", "é"), (-3, 1, "u", "q"), (100, 1, "a", "z")]
    for c in range(200, 320):
        rows += [(c, t, "ua"[t % 2], str(rng.random()) if rng.random() < 0.05 else "same") for t in range(rng.choice([1, 2, 3, 5, longest]))]
    rows += [(c, t, "u", "same") for c in range(400, 440) for t in range(3)]
    return [(*r, "x", "y") for r in rows]


@pytest.mark.parametrize("longest", [8, 64, 65, 150])
def test_trie_of_odd_rows(spark, longest):
    """Turnless ones, lone families, equal rows, nulls, blocks just full and just beyond, hot prefixes."""
    rows = conversations(random.Random(longest), longest)
    got = trie.prefix_trie(spark.createDataFrame(rows, COLUMNS).repartition(3))
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_trie(rows)


def test_trie_of_one_long_conversation(spark):
    """Three tiers of blocks: a conversation of more than 64 * 64 turns, one that ends with a block, one within another."""
    rows = [(c, t, "u", "same" if t % 5 else str(t), "", "") for c, n in ((700, 4300), (701, 4096), (702, 128), (703, 1)) for t in range(n)]
    got = trie.prefix_trie(spark.createDataFrame(rows, COLUMNS))
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_trie(rows)


def test_trie_without_turns(spark):
    assert trie.prefix_trie(spark.createDataFrame([], COLUMNS)).count() == 0
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "u", "x", "", "")], COLUMNS)).count() == 0
    lone = [(c, 1, "u", "x", "", "") for c in range(1, 9)]
    assert sorted((tuple(r) for r in trie.prefix_trie(spark.createDataFrame(lone, COLUMNS)).collect()), key=str) == plain_trie(lone)


def test_registered():
    assert {"op11_secret_spans", "op12_lexical_search", "op13_prefix_trie"} <= set(registry.QUERIES)
    assert {"op12_lexical_search", "op13_prefix_trie"} <= set(registry.ORACLE)
