"""Context mixing: what is stored, texts without words, orders of hashes."""

import os

import numpy as np

from clearspan.llm import mixing
from clearspan.session import ensure_checkpoint_dir


def test_what_buckets_ask_is_not_stored(spark):
    """Texts and answers are the only tables that a run stores."""
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    table = spark.createDataFrame([(k, f"w{k % 7} w{k % 3} and more") for k in range(40)], "doc_id long, text string")
    assert mixing.scored(table).count() == 40
    assert sorted(x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before) == ["mixing-answers", "mixing-texts"]


def test_texts_without_words(spark):
    """Nothing but empty and missing texts: each has its end token."""
    table = spark.createDataFrame([(k, None if k % 2 else " ") for k in range(6)], "doc_id long, text string")
    rows = mixing.scored(table).collect()
    assert len(rows) == 6 and all(r.n_tokens == r.n_known == 1 and r.score < 0 for r in rows)


def test_hashes_that_differ_in_lower_bits_only_are_in_order():
    """Hashes equal in the bits that are sorted come in order nevertheless, each place once."""
    rng = np.random.default_rng(3)
    key = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    key[1::3] = key[::3] ^ np.uint64(1)
    key[2::3] = key[::3] ^ np.uint64(2)
    order = mixing._hash_order(key)
    assert (key[order] == np.sort(key)).all() and len(set(order.tolist())) == len(key)


def test_words_are_known_by_the_hash_at_their_end():
    """Equal words share a hash wherever they stand, others don't; places and numbers are those of the way that scores."""
    texts = [b"the cat the", b"", b"a cat\nat", b"the"]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    starts, ends, before = mixing.words_of(raw, np.cumsum([0, *map(len, texts)]))
    plain, text_at, token_at = mixing.plain_bytes(raw, starts, ends, before)
    trains = np.repeat([True, True, False, True], np.diff(np.append(text_at, len(plain))))
    places, hashes = mixing.places_and_words(plain, text_at, token_at, trains)
    want, which = mixing.places_of(plain, text_at, token_at, trains)
    words = b" ".join(texts).split()
    assert len(hashes) == len(words) and len(set(hashes.tolist())) == len(set(words)) == len(set(zip(words, hashes.tolist(), strict=True)))
    assert (mixing.mix(want.word[which[mixing.word_ends(len(plain), token_at)]]) == hashes).all()
    assert (places.key == want.key).all() and (places.n == want.n).all() and (places.word == want.word).all()
