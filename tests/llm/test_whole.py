"""Results that must be whole: repeated runs of lines to their ends, rows that share an id, and others."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clearspan.llm import jaccard, linedup, mixing, vectors
from clearspan.llm.spans import words_of


def kept_lines(data, min_words):
    """Lines that stay by brute force: a line goes with any run of ``min_words`` words or more that begins at an earlier place too."""
    lines = {d: [(i, tuple(re.findall(r"[^\x20\x09-\x0D]+", x))) for i, x in enumerate(t.split("\n"))] for d, t in data}
    full = {d: [(i, w) for i, w in own if w] for d, own in lines.items()}
    seen, gone = {}, set()
    for d in sorted(full):
        own = full[d]
        for a in range(len(own)):
            for b in range(a, len(own)):
                if sum(len(w) for _, w in own[a : b + 1]) >= min_words:
                    content = tuple(w for _, w in own[a : b + 1])
                    if seen.setdefault(content, (d, own[a][0])) < (d, own[a][0]):
                        gone |= {(d, i) for i in range(own[a][0], own[b][0] + 1)}
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in data}


def run_of(tag, n):
    return " ".join(f"{tag}{k}" for k in range(n))


def test_repeated_runs_go_to_their_last_line(spark):
    """The tail of a repeated run has too few words for a window of its own."""
    a, b, c, d = run_of("a", 60), run_of("b", 10), run_of("c", 40), run_of("d", 30)
    data = [(1, f"x\n{a}\n{b}\ny"), (2, f"z\n{a}\n\n{b}\nw"), (3, f"{c}\n{d}\n{b}\nq"), (4, f"{c}\n{d}\n{b}\nr"), (5, f"{b}\n{c}\n{d}")]
    table = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_removed) for r in linedup.without_repeats(table).collect()}
    assert got == {1: (data[0][1], 0), 2: ("z\nw", 2), 3: (data[2][1], 0), 4: ("r", 3), 5: (b, 2)}


def test_repeated_runs_against_brute_force(spark):
    rng = np.random.default_rng(1)
    pool = [run_of(f"p{k}x", int(rng.integers(1, 9))) for k in range(7)]
    data = []
    for doc_id in range(40):
        own = [pool[k] if k < len(pool) else "" if k == len(pool) else f"u{doc_id} only" for k in rng.integers(0, len(pool) + 2, int(rng.integers(1, 14)))]
        data.append((doc_id, "\n".join(own)))
    table = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    want = kept_lines(data, 12)
    assert want != dict(data)
    assert {r.doc_id: r.text for r in linedup.without_repeats(table, 12).collect()} == want


def test_one_of_each_of_texts_that_share_an_id(spark):
    """Every component keeps a row, also if its least id is another component's too."""
    texts = [run_of(t, 40) for t in "abc"]
    data = [(7, texts[0]), (7, texts[1]), (7, texts[2]), (7, texts[2]), (8, texts[0] + " x"), (9, texts[1]), (None, texts[2] + " y")]
    table = spark.createDataFrame(data, "doc_id long, text string")
    assert sorted(tuple(r) for r in jaccard.one_of_each(table).collect()) == [(7, t) for t in texts]


def plain_of(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    starts, ends, before = words_of(raw, np.array([0, len(raw)]))
    return mixing.plain_bytes(raw, starts, ends, before)


def test_places_know_only_their_own_text():
    """The window of a byte is the five bytes before it in its text, the word hash that of the word so far."""
    raw = np.frombuffer(b"the cat\nthe\n\nca\n", np.uint8)
    text_at, token_at = np.array([0, 8, 12, 13]), np.array([0, 4, 8, 12, 13])
    window, word = mixing.histories(raw, text_at, token_at)
    for i in range(len(raw)):
        start = max(t for t in text_at if t <= i)
        before = (b"\n" * 5 + raw[start:i].tobytes())[-5:]
        assert window[i] == int.from_bytes(before + raw[i : i + 1].tobytes(), "little")
    assert word[1] == word[9] != word[5] and word[0] == word[4] == word[12] and word[5] == word[14] and word[6] == word[15]
    places, which = mixing.places_of(raw, text_at, token_at, np.ones(len(raw), bool))
    assert (places.window[which] == window).all() and (places.word[which] == word).all() and places.n.sum() == len(raw)
    assert len(places.key) == len(set(zip(window.tolist(), word.tolist(), strict=True)))


def test_context_counts_grow_with_the_corpus(spark):
    """Every context of a bucket has its whole corpus's counts, in any number of shards; held-out texts count nothing."""
    data = [(k % 3, k % 5 == 0, run_of(f"w{k % 4}", 6)) for k in range(20)]
    table = spark.createDataFrame(data, "bucket long, held_out boolean, text string").repartition(4)
    shards, want, own_of, words = 7, Counter(), {}, Counter()
    code = mixing.Code.of(np.ones(256))
    for bucket, held, text in data:
        plain, text_at, token_at = plain_of(text)
        places, which = mixing.places_of(plain, text_at, token_at, np.ones(len(plain), bool))
        words.update([] if held else text.split())
        for k in range(mixing.PREDICTORS):
            for key, rank in zip(mixing.wire(places.contexts(k), shards)[which].tolist(), code.ranks[plain].tolist(), strict=True):
                want[k, key, rank] += not held
                own_of.setdefault((bucket, k), set()).add(key)
    sent = mixing._gathered(table, code, shards)
    assert mixing._word_totals(sent) == (sum(words.values()), len(words))
    got, found = Counter(), {}
    for r in mixing._answered(sent.filter("bucket IS NOT NULL").drop("rest")).orderBy("shard").collect():
        for have, more in zip(found.setdefault((r.bucket, r.predictor), [[], [], []]), mixing.unpacked(r.answer, "<u4", "u1", "<u8"), strict=True):
            have += more.tolist()
    for (bucket, k), own in own_of.items():
        size, rank, n = found[bucket, k]
        keys = np.repeat(np.array(sorted(own), np.uint64), size)
        for key, r, x in zip(keys.tolist(), rank, n, strict=True):
            got[bucket, k, key, r] += x
    assert got == Counter({(b, k, c, r): n for (k, c, r), n in want.items() for b in range(3) if n and c in own_of[b, k]})


def test_evidence_is_that_of_a_plain_walk():
    """The logit at a bit is that of all bytes that followed its context through the same node."""
    plain, text_at, token_at = plain_of(" ".join(run_of(f"w{k % 5}", 7) for k in range(40)))
    places, which = mixing.places_of(plain, text_at, token_at, np.ones(len(plain), bool))
    code = mixing.Code.of(np.bincount(plain, minlength=256))
    nothing = mixing.Places(places.key, places.window, places.word, 0 * places.n)
    model = model_of(code, np.zeros(1 + mixing.GATES * (mixing.PREDICTORS + 2 * mixing.CELLS)), places, nothing)
    path = [[(int(n), int(b)) for n, b in zip(code.nodes[x], code.bits[x], strict=True)][: code.lengths[x]] for x in range(256)]
    for k in range(mixing.PREDICTORS):
        key = mixing.wire(places.contexts(k), 3).tolist()
        seen = Counter()
        for context, byte, n in zip(key, places.byte.tolist(), places.n.tolist(), strict=True):
            for step in path[byte]:
                seen[context, step] += n
        got = model.evidence[k]
        for i, (context, byte) in enumerate(zip(key, places.byte.tolist(), strict=True)):
            for depth, (node, _) in enumerate(path[byte]):
                zeros, ones = seen[context, (node, 0)], seen[context, (node, 1)]
                assert got.seen[got.first[i] + depth] and got.logit[got.first[i] + depth] == pytest.approx(np.log((ones + 0.2) / (zeros + 0.2)), abs=1e-4)


def model_of(code, rest, trained, scored, shards=3):
    """A model of the counts of ``trained`` for the contexts of ``scored``, which count nothing, without Spark."""
    parts, evidence = {}, [None] * mixing.PREDICTORS
    for bucket, places in ((0, trained), (1, scored)):
        for k, pair, which in mixing.pairs_of(places, code, shards):
            for shard, data in mixing.asked(pair, np.bincount(which, places.n)):
                parts.setdefault((k, shard), []).append((bucket, data))
    for k, pair, which in mixing.pairs_of(scored, code, shards):
        out = [mixing.answers(parts[x], 8)[0] for x in sorted(parts) if x[0] == k]
        answer = zip(*(mixing.unpacked(o[1], "<u4", "u1", "<u8") for o in out if 1 in o), strict=True)
        evidence[k] = mixing.Evidence.of(pair, which, tuple(np.concatenate(x) for x in answer), code)
    return mixing.Model(mixing.Fixed.of(code, rest), evidence)


def test_mixing_is_a_distribution():
    """Over all next bytes, the spelled probabilities of a trained model add up to 1, and it learns."""
    plain, text_at, token_at = plain_of("the cat sat on the mat " * 300)
    code = mixing.Code.of(np.bincount(plain, minlength=256))
    learner = mixing.Learner(code)
    trained, _ = mixing.places_of(plain, text_at, token_at, np.ones(len(plain), bool))
    for _ in range(4):
        learner.learn(trained)
    texts = [b"the ca" + bytes([b]) for b in range(256)] + [b"the cat sat ", b"tac eht tas "]
    tokens = np.array([0])  # every text one token, from its first byte
    parts = [mixing.places_of(np.frombuffer(t, np.uint8), tokens, tokens, np.zeros(len(t), bool)) for t in texts]
    places = mixing.Places.joined([p for p, _ in parts])
    each = model_of(code, learner.rest(), trained, places).place_scores(places)
    spelled = [each[np.searchsorted(places.key, p.key)][w] for p, w in parts]
    assert sum(10 ** s[-1] for s in spelled[:256]) == pytest.approx(1, abs=1e-3)
    assert spelled[256].sum() > spelled[257].sum() + 3


def test_shares_of_two_experts():
    """A text's probability is the mean over the shares; each share mixes the experts token by token."""
    spelled, share, owner = np.array([-1.0, -3.0, -2.0]), np.array([0.5, 0.0, 0.2]), np.array([0, 0, 2])
    got = 10 ** mixing.mixed_shares(spelled, share, owner, 3)
    for text in range(3):
        own = [np.prod([(1 - x) * 10 ** spelled[i] + x * share[i] for i in range(3) if owner[i] == text]) for x in mixing.SHARES]
        assert got[text] == pytest.approx(np.mean(own))


def test_buckets_are_cut_by_size(spark):
    """Rows with one id and one text, a third of all, lie in many buckets; every bucket size gives every row a score."""
    data = [(7, run_of("a", 40))] * 40 + [(k, run_of(f"b{k}", 40)) for k in range(80)] + [(None, None), (3, "")]
    table = spark.createDataFrame(data, "doc_id long, text string").coalesce(1)
    cut = mixing._bucketed(table.select(mixing.held_out(F.col("doc_id"), 10).alias("held_out"), "text", "doc_id"), 2000)
    sizes = [r.n for r in cut.filter("bucket IS NOT NULL").groupBy("bucket").agg(F.sum(F.length("text")).alias("n")).collect()]
    assert len(sizes) > 5 and max(sizes) < 2400
    one, many = (sorted(map(tuple, mixing.scored(table, size=s).drop("score").collect()), key=str) for s in (1 << 20, 2000))
    assert len(one) == len(data) and [r[:5] + r[6:] for r in one] == [r[:5] + r[6:] for r in many]
    assert [r[5] for r in one] == pytest.approx([r[5] for r in many])


def test_weights_move_in_a_small_partition():
    """A task's only bucket is predicted from counts too, not from empty tables; all that comes is learned."""
    plain, text_at, token_at = plain_of(" ".join(run_of(f"w{k % 7}", 9) for k in range(30)))
    code = mixing.Code.of(np.bincount(plain, minlength=256))
    learner = mixing.Learner(code)
    learner.learn(mixing.places_of(plain, text_at, token_at, np.ones(len(plain), bool))[0])
    assert (learner.weights[2:] != 0.3).any() and learner.map_all.reshape(mixing.GATES, -1)[2:].sum() > 0
    assert learner.n_bits == code.lengths[plain].sum() and (learner.counts.sum(axis=1) == learner.n_bits).all()


def test_rows_that_share_an_id_are_candidates(spark):
    """Only a query's own row is no candidate, not the others with its id."""
    data = [(0, [1.0]), (0, [4.0]), (1, [3.0]), (1, [2.0]), (1, [2.0])]
    v = vectors.integer_vectors(spark.createDataFrame(data, "vec_id long, embedding array<double>"), 1)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in vectors.top_k(v, v.filter("vec_id = 0"), 9, block=2).collect())
    first, second = [(0, 4), (1, 3), (1, 2), (1, 2)], [(1, 12), (1, 8), (1, 8), (0, 4)]
    assert got == sorted((0, k + 1, *x) for own in (first, second) for k, x in enumerate(own))
