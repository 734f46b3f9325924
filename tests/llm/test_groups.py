"""Jaccard join with small groups: families over many groups, hubs, bounds and plans against brute force."""

import random

import numpy as np
import pytest

from clearspan.llm import jaccard


def components(texts, n, num, den):
    """Least id of each text's component by comparing all pairs."""
    def cut(t):
        w = t.lower().split()
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())

    sets = {d: cut(t) for d, t in texts}
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            o = len(sets[a] & sets[b])
            if sets[a] and sets[b] and den * o >= num * (len(sets[a]) + len(sets[b]) - o):
                up[max(root(a), root(b))] = min(root(a), root(b))
    return {d: root(d) for d in ids}


def families(rng):
    """Near copies of few texts, chains that only link step by step, texts that share a passage, short ones and strangers."""
    word = lambda: f"w{rng.randrange(3000)}"
    out, passage = [], [word() for _ in range(30)]
    for base in range(3):
        words = [word() for _ in range(60 + 40 * base)]
        for _ in range(50):
            own = list(words)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = word()
            out.append(" ".join(own))
    chain = [word() for _ in range(80)]
    for k in range(25):
        chain[3 * k] = word()
        out.append(" ".join(chain))
    out += [" ".join([word() for _ in range(40)] + passage + [word() for _ in range(20)]) for _ in range(30)]
    out += [" ".join(passage + [word() for _ in range(k % 4)]) for k in range(20)]
    out += ["", "one two", "one two", "One TWO three", " ".join(word() for _ in range(400))]
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize(("group", "guests", "n", "num", "den"), [(256, 1024, 5, 8, 10), (4, 3, 5, 8, 10), (2, 2, 3, 9, 10), (3, 5, 2, 6, 10)])
def test_components_of_families_over_many_groups(spark, monkeypatch, group, guests, n, num, den):
    monkeypatch.setattr(jaccard, "GROUP", group)
    monkeypatch.setattr(jaccard, "GUESTS", guests)
    texts = families(random.Random(group + n))
    table = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in jaccard.similar(table, n, num, den).collect()}
    want = components(texts, n, num, den)
    assert len(set(want.values())) < len(texts) - 100
    assert got == want


def test_need_is_a_lower_bound_of_common_tokens():
    """Any two sets at the threshold share as many tokens as either needs."""
    rng = np.random.default_rng(2)
    for size in (3, 9, 20, 75, 300, 1500):
        for _ in range(30):
            a = np.unique(rng.integers(1, 1 << 63, size, dtype=np.uint64))
            b = a.copy()
            for _ in range(rng.integers(0, max(1, len(a) // 6) + 1)):
                b[rng.integers(0, len(b))] = rng.integers(1, 1 << 63, dtype=np.uint64)
            b = np.unique(b[rng.integers(0, 2) :])
            o = len(np.intersect1d(a, b))
            if not len(b) or 10 * o < 8 * (len(a) + len(b) - o):
                continue
            owner, tokens, need = jaccard.part_tokens(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 8, 10)
            assert len(np.intersect1d(tokens[owner == 0], tokens[owner == 1])) >= max(need)


def test_a_family_opens_about_as_many_pairs_as_groups(spark, monkeypatch):
    """Near copies over many groups meet a hub; hardly any two groups are opened for each other afterwards."""
    monkeypatch.setattr(jaccard, "GROUP", 16)
    opened = []
    real = jaccard._open_sides

    def counted(*args):
        sides = real(*args)
        opened.append(sides.select("ga", "gb").distinct().count())
        return sides

    monkeypatch.setattr(jaccard, "_open_sides", counted)
    rng = random.Random(9)
    words = [f"w{k}" for k in range(150)]
    texts = []
    for k in range(320):
        own = list(words)
        own[rng.randrange(150)] = f"x{k}"
        texts.append((k, " ".join(own)))
    got = jaccard.similar(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0}
    assert opened[0] <= 320 // 16
