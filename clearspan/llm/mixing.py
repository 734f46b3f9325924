"""Language-model scores by online logistic context mixing (operator 3).

A text is written as its words in lower case, a space after each, and a line feed at the end,
and predicted bit by bit along a prefix code of bytes. For each bit several predictors, each
with a hashed context (the last one, two, three, five bytes; the word so far), give a
probability from the bits counted there. Their logits are added with weights that a gate
chooses (the longest context seen before, and whether the bit is a byte's first), and the sum
is refined by an adaptive map from gate and logit to the frequency found there.

One pass over buckets of texts learns and counts. A byte of equal history (its last five bytes
and the word so far) has equal contexts, so a bucket's equal places are worked out once. A task
learns in small steps: each is predicted from what the task has seen so far, then corrects the
weights and is counted; a place that comes often is learned in several parts, so that its later
parts meet the earlier ones' counts. Weights are averaged by bits.

What followed each context in the whole corpus is counted apart, in rows that grow with the
input and are never collected: a bucket sends its contexts, the bytes after them and their
numbers to shards of contexts, and each shard answers with what followed these contexts in all
training texts. An answer names no context, for the bucket knows its own in order. Words are
counted the same way. Scoring changes nothing, so that a text's score depends on the model and
the text alone.

A token's spelling and its share among the training tokens (0 for unknown words) are two
experts; shares of several sizes between them are weighted by how well each did on the text so
far, which is the mean of the whole text's probability over the sizes. Every size gives a
proper distribution, and so does their mean.

The base score is a word model with the corpus's word counts.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearspan.llm.common import need, written
from clearspan.llm.spans import blocks, lowered, mix, words_of
from clearspan.llm.toxicity import held_out
from clearspan.session import shuffles_dropped

#: Bits of a predictor's table in a training task, which learns weights and the map there.
TABLE_BITS = 20
ORDERS = (1, 2, 3, 5)
#: Bytes of text for each shard of the corpus's context counts.
SHARD = 1 << 24
#: Bytes of text in a bucket, which one task scores; a longer text is a bucket of its own.
BUCKET = 1 << 24
PREDICTORS = len(ORDERS) + 1
#: The number under which words are counted, next to the predictors.
WORDS = PREDICTORS
GATES = 2 * (PREDICTORS + 1)
#: Cells of the adaptive map for each gate.
CELLS = 48
#: Bytes of text in a batch, and distinct places worked on at a time.
BATCH, STEP = 1 << 18, 1 << 14
#: Places of a bucket that wait for being joined with the others.
JOINED = 1 << 20
#: Steps in which a bucket is learned at least, so that small tables are predicted from counts too.
LEAST_STEPS = 64
#: How much of a token's probability is its share among the training tokens; the rest is its spelling.
SHARES = (0.02, 0.3, 0.6, 0.8, 0.9, 0.97)
_SPACE, _END = 32, 10
_PRIME, _SPIN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SMALL = np.uint32(0x9E3779B1)
_LONGEST = max(ORDERS)
_EIGHT = np.uint64(8)
_LOW32, _LOW40 = np.uint64((1 << 32) - 1), np.uint64((1 << 40) - 1)


@dataclass
class Code:
    """A prefix code of bytes: for each byte the number of bits, the bits, and the tree node before each.

    ``ranks`` are the bytes' places in the order of their codes, ``borders`` the least rank that has
    a one at a node.
    """

    lengths: np.ndarray
    bits: np.ndarray
    nodes: np.ndarray
    ranks: np.ndarray
    by_rank: np.ndarray
    borders: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Code:
        """The Huffman code of byte counts; a small addition keeps the codes of unseen bytes short."""
        weights = counts.astype(float) + counts.sum() / 4096 + 1
        heap: list[tuple] = [(w, k, k) for k, w in enumerate(weights.tolist())]
        heapq.heapify(heap)
        made = 256
        children: dict[int, tuple[int, int]] = {}
        while len(heap) > 1:
            (wa, ka, a), (wb, kb, b) = heapq.heappop(heap), heapq.heappop(heap)
            children[made] = (a, b)
            heapq.heappush(heap, (wa + wb, made, made))
            made += 1
        codes: dict[int, list[tuple[int, int]]] = {}
        stack: list[tuple[int, list]] = [(heap[0][2], [])]
        while stack:
            node, path = stack.pop()
            if node < 256:
                codes[node] = path
            else:
                for bit in (0, 1):
                    stack.append((children[node][bit], [*path, (node - 255, bit)]))
        lengths = np.array([len(codes[k]) for k in range(256)], np.int64)
        bits, nodes = np.zeros((256, lengths.max()), np.float32), np.zeros((256, lengths.max()), np.uint32)
        for k, path in codes.items():
            nodes[k, : len(path)] = [n * 0x85EBCA6B & 0xFFFFFFFF for n, _ in path]
            bits[k, : len(path)] = [b for _, b in path]
        ranks, borders = np.zeros(256, np.uint64), np.zeros((256, lengths.max()), np.int64)
        least: dict[int, int] = {}
        for rank, k in enumerate(sorted(codes, key=lambda k: [b for _, b in codes[k]])):
            ranks[k] = rank
            for node, bit in codes[k]:
                if bit:
                    least.setdefault(node, rank)
        for k, path in codes.items():
            borders[k, : len(path)] = [least[node] for node, _ in path]
        return cls(lengths, bits, nodes, ranks, np.argsort(ranks).astype(np.uint8), borders)


def plain_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes that are predicted, the first byte of each text in them, and the first byte of each token (words, then an end)."""
    counts = np.diff(before)
    item_at = before + np.arange(len(before))
    lengths = np.zeros(int(item_at[-1]), np.int64)
    word_item = np.arange(len(starts)) + np.repeat(np.arange(len(counts)), counts)
    size = ends - starts
    lengths[word_item] = size
    first = np.concatenate([[0], np.cumsum(lengths + 1)])
    out = np.full(int(first[-1]), _SPACE, np.uint8)
    out[first[item_at[1:]] - 1] = _END
    within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(first[word_item], size) + within] = data[np.repeat(starts, size) + within]
    return out, first[item_at[:-1]], first[:-1]


@dataclass
class Places:
    """Distinct places of texts: what stands before a byte, the byte, and how often that comes in training texts.

    ``window`` has the longest context's bytes with the byte itself on top, ``word`` the hash of the word so far.
    """

    key: np.ndarray
    window: np.ndarray
    word: np.ndarray
    n: np.ndarray

    @property
    def byte(self) -> np.ndarray:
        return (self.window >> np.uint64(8 * _LONGEST)).astype(np.uint8)

    def contexts(self, k: int) -> np.ndarray:
        """Hashed context of predictor ``k`` at each place."""
        if k == PREDICTORS - 1:
            return self.word
        before = self.window & np.uint64((1 << 8 * _LONGEST) - 1)
        return ((before >> np.uint64(8 * (_LONGEST - ORDERS[k]))) + np.uint64(ORDERS[k])) * _PRIME

    def take(self, at: np.ndarray | slice) -> Places:
        return Places(self.key[at], self.window[at], self.word[at], self.n[at])

    @classmethod
    def joined(cls, parts: list[Places]) -> Places:
        """All places of ``parts`` once, ordered by key, with their numbers added up."""
        if not parts:
            none = np.zeros(0, np.uint64)
            return cls(none, none, none, np.zeros(0, np.int64))
        key = np.concatenate([p.key for p in parts])
        order, first = _groups(key, _hash_order(key))
        at = order[first]
        n = np.concatenate([p.n for p in parts])[order]
        return cls(
            key[at],
            np.concatenate([p.window for p in parts])[at],
            np.concatenate([p.word for p in parts])[at],
            np.add.reduceat(n, first) if len(first) else n,
        )


def put(parts: list[Places], more: Places) -> None:
    """Add places to the others of a bucket, which are joined whenever many have come."""
    parts.append(more)
    if sum(len(p.key) for p in parts[1:]) > JOINED:
        parts[:] = [Places.joined(parts)]


def _hash_order(key: np.ndarray) -> np.ndarray:
    """An order by hashes that spread over all 64 bits: one plain sort of their upper bits with the place in the lower ones."""
    low = np.uint64((1 << max(1, len(key)).bit_length()) - 1)
    order = (np.sort((key & ~low) | np.arange(len(key), dtype=np.uint64)) & low).astype(np.int64)
    ranked = key[order]
    # the few that are equal in the upper bits only are put in order by swaps of neighbours
    while len(wrong := np.flatnonzero(ranked[1:] < ranked[:-1])):
        wrong = wrong[np.diff(wrong, prepend=-2) > 1]
        for x in (order, ranked):
            x[wrong], x[wrong + 1] = x[wrong + 1], x[wrong]
    return order


def _groups(key: np.ndarray, order: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """An order by key (``order``, if given), and where in it each distinct key begins."""
    order = np.argsort(key) if order is None else order
    ranked = key[order]
    new = np.ones(len(key), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    return order, np.flatnonzero(new)


def _distinct(key: np.ndarray) -> np.ndarray:
    """Each key once, in order."""
    key = np.sort(key)
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return key[new]


def histories(text: np.ndarray, text_at: np.ndarray, token_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Window and word hash of each byte: only what stands before it in its text, line feeds before its first byte."""
    n = len(text)
    padded = np.full(n + 7, _END, np.uint8)
    padded[7:] = text
    window = np.ndarray((n,), "<u8", padded, 0, (1,)) >> np.uint64(8 * (7 - _LONGEST))
    size = np.diff(np.append(text_at, n))
    for k in range(_LONGEST):  # the text's byte k has bytes of the text before in all but k of those before it
        at = text_at[size > k] + k
        own = np.uint64(8 * (_LONGEST - k))
        window[at] = ((window[at] >> own) << own) | np.uint64(int.from_bytes(bytes([_END]) * (_LONGEST - k), "little"))
    size = np.diff(np.append(token_at, n))
    inside = np.arange(n) - np.repeat(token_at, size)
    power = np.multiply.accumulate(np.full(int(size.max(initial=0)) + 1, _SPIN, np.uint64)).take(inside)
    power *= text.astype(np.uint64) + np.uint64(1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(power, out=total[1:])
    word = total[:-1] - np.repeat(total[token_at], size)
    word += np.uint64(77)
    word *= _PRIME
    return window, word


def _keyed(window: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of bytes by their histories, an order in which equal ones are neighbours, and where in it each key begins."""
    key = window ^ (word >> np.uint64(31))
    key *= _SPIN
    key += word
    key ^= key >> np.uint64(32)
    # ordered by the key's upper bits, with the place in the lower ones: one plain sort
    low = np.uint64((1 << max(1, len(key)).bit_length()) - 1)
    order = (key & ~low) | np.arange(len(key), dtype=np.uint64)
    order.sort()
    order &= low
    order = order.view(np.int64)
    ranked = key.take(order)
    new = np.ones(len(key), bool)
    np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
    return key, order, new


def places_of(text: np.ndarray, text_at: np.ndarray, token_at: np.ndarray, trains: np.ndarray | None = None) -> tuple[Places, np.ndarray]:
    """Distinct places of a batch, and which of them every byte is; ``trains`` says which bytes count, none without it."""
    window, word = histories(text, text_at, token_at)
    key, order, new = _keyed(window, word)
    which = np.empty(len(key), np.int32)
    which[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    at = order[new]
    n = np.zeros(len(at), np.int64) if trains is None else np.bincount(which[trains], minlength=len(at))
    return Places(key.take(at), window.take(at), word.take(at), n), which


def places_and_words(text: np.ndarray, text_at: np.ndarray, token_at: np.ndarray, trains: np.ndarray) -> tuple[Places, np.ndarray]:
    """Distinct places of a batch, and the hash of each word; ``trains`` says which bytes count."""
    window, word = histories(text, text_at, token_at)
    key, order, new = _keyed(window, word)
    first = np.flatnonzero(new)
    at = order.take(first)
    n = np.add.reduceat(trains.take(order), first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)
    return Places(key.take(at), window.take(at), word.take(at), n), mix(word.take(word_ends(len(text), token_at)))


def word_ends(n: int, token_at: np.ndarray) -> np.ndarray:
    """The byte after each word; there the word so far is the whole word. An end of a text is one byte, and no word."""
    size = np.diff(np.append(token_at, n))
    return (token_at + size - 1)[size > 1]


def slots(contexts: list[np.ndarray], text: np.ndarray, code: Code) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every bit of the bytes: its slot in each predictor's table (predictors x bits), the bit, whether it is a first one, and its byte."""
    lengths = code.lengths[text]
    owner = np.repeat(np.arange(len(text)), lengths)
    depth = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    step = (text.astype(np.int64) * code.bits.shape[1]).take(owner) + depth
    node = code.nodes.ravel().take(step)
    out = np.empty((len(contexts), len(owner)), np.int64)
    for k, context in enumerate(contexts):
        mixed = ((context ^ (context >> np.uint64(29))) * _SPIN >> np.uint64(32)).astype(np.uint32).take(owner)
        mixed ^= node
        mixed *= _SMALL
        mixed ^= mixed >> np.uint32(15)
        mixed *= _SMALL
        out[k] = mixed >> np.uint32(32 - TABLE_BITS)
    return out, code.bits.ravel().take(step), depth == 0, owner


def logits(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logit of a predictor's counts, 0 where nothing was counted."""
    few = np.float32(0.2)
    return np.log((ones + few) / (zeros + few))


def mixed_logit(inputs: np.ndarray, weights: np.ndarray, gate: np.ndarray) -> np.ndarray:
    """The weighted sum of the predictors' logits; ``weights`` has a row for each gate."""
    total = np.zeros(len(gate), np.float32)
    for k in range(PREDICTORS):
        total += inputs[k] * weights[:, k].astype(np.float32).take(gate)
    return total


def gates(longest: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which weights a bit takes: by its longest context that was seen (0: none), and whether it is a byte's first."""
    return 2 * longest.astype(np.int64) + first


def cells(gate: np.ndarray, logit: np.ndarray) -> np.ndarray:
    """Cell of the adaptive map."""
    return gate * CELLS + np.clip((logit + np.float32(12)) * np.float32(CELLS / 24), 0, CELLS - 1).astype(np.int64)


def refined(logit: np.ndarray, ones: np.ndarray, all_: np.ndarray) -> np.ndarray:
    """Probability of a one: the mixed probability, moved half way to the frequency in its cell."""
    p = 1 / (1 + np.exp(-logit))
    return np.clip(0.5 * p + 0.5 * (ones + 16 * p) / (all_ + 16), np.float32(1e-6), np.float32(1 - 1e-6))


class Learner:
    """One task's counts, weights and map, from nothing."""

    def __init__(self, code: Code):
        self.code = code
        #: for each slot, how often a zero and a one followed
        self.counts = np.zeros((PREDICTORS, 2 << TABLE_BITS), np.float32)
        self.weights = np.full((GATES, PREDICTORS), 0.3)
        self.m, self.v, self.t = np.zeros_like(self.weights), np.zeros_like(self.weights), 0
        self.map_all, self.map_ones = np.zeros(GATES * CELLS), np.zeros(GATES * CELLS)
        self.n_bits = 0

    def learn(self, places: Places) -> None:
        """In small steps: predict from what was seen, correct weights and map, then count.

        A place that comes ``n`` times is learned in parts of 1, 3, 12, 48 and so on, in any order.
        """
        at, times = [], []
        done, size = 0, 1
        left = np.flatnonzero(places.n > 0)
        while len(left):
            at.append(left)
            times.append(np.minimum(places.n[left] - done, size))
            done, size = done + size, 3 * (done + size)
            left = left[places.n[left] > done]
        if not at:
            return
        at, times = np.concatenate(at), np.concatenate(times).astype(np.float32)
        order = np.random.default_rng(self.n_bits).permutation(len(at))
        step = min(STEP, max(1, -(-len(order) // LEAST_STEPS)))
        for a in range(0, len(order), step):
            own = order[a : a + step]
            some = places.take(at[own])
            found, bit, first, owner = slots([some.contexts(k) for k in range(PREDICTORS)], some.byte, self.code)
            n = times[own].take(owner)
            self._correct(found, bit, first, n)
            found <<= 1
            found += bit.astype(np.int64)
            for k in range(PREDICTORS):
                np.add.at(self.counts[k], found[k], n)

    def _correct(self, at: np.ndarray, bit: np.ndarray, first: np.ndarray, times: np.ndarray) -> None:
        """One step of weights and map on bits that stand for ``times`` each."""
        inputs = np.empty(at.shape, np.float32)
        longest = np.zeros(len(bit), np.int8)
        for k in range(PREDICTORS):
            both = self.counts[k].view(np.uint64).take(at[k])  # a zero's and a one's count in one read
            each = both.view(np.float32)
            inputs[k] = logits(each[::2], each[1::2])
            np.maximum(longest, (both != 0).view(np.int8) * np.int8(k + 1), out=longest)
        gate = gates(longest, first)
        logit = mixed_logit(inputs, self.weights, gate)
        wrong = times * (bit - 1 / (1 + np.exp(-logit)))
        total = np.bincount(gate, times, GATES) + 1.0
        grad = np.stack([np.bincount(gate, wrong * inputs[k], GATES) for k in range(PREDICTORS)], axis=1) / total[:, None]
        self.t += 1
        self.m, self.v = 0.9 * self.m + 0.1 * grad, 0.99 * self.v + 0.01 * grad * grad
        step = 0.03 * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.99**self.t)) + 1e-4)
        self.weights += np.where((total > 1)[:, None], step, 0)
        cell = cells(gate, logit)
        self.map_all += np.bincount(cell, times, GATES * CELLS)
        self.map_ones += np.bincount(cell, times * bit, GATES * CELLS)
        self.n_bits += int(times.sum())

    def rest(self) -> np.ndarray:
        """Number of bits, weights times that number, and map."""
        return np.concatenate([[self.n_bits], (self.weights * self.n_bits).ravel(), self.map_all, self.map_ones])


@dataclass
class Fixed:
    """What every scoring task has alike; its size does not depend on the corpus."""

    code: Code
    weights: np.ndarray
    map_all: np.ndarray
    map_ones: np.ndarray

    @classmethod
    def of(cls, code: Code, rest: np.ndarray) -> Fixed:
        """Weights and map from the sum of what the tasks learned."""
        weights = rest[1 : 1 + GATES * PREDICTORS].reshape(GATES, PREDICTORS)
        weights = weights / rest[0] if rest[0] else np.full((GATES, PREDICTORS), 0.3)
        return cls(code, weights, *rest[1 + GATES * PREDICTORS :].reshape(2, -1).astype(np.float32))


@dataclass
class Followers:
    """What followed a bucket's contexts of one predictor: ranks of bytes and their running numbers, context by context."""

    start: np.ndarray
    rank: np.ndarray
    place: np.ndarray
    before: np.ndarray

    @classmethod
    def of(cls, size: np.ndarray, rank: np.ndarray, n: np.ndarray) -> Followers:
        """``size`` says how many bytes followed each context, in the order of the contexts' keys."""
        start = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        place = (np.repeat(np.arange(len(size)), size) << 8) | rank
        return cls(start, rank, place, np.concatenate([[0.0], np.cumsum(n, dtype=np.float64)]))

    def counted(self, group: np.ndarray, byte: np.ndarray, code: Code) -> tuple[np.ndarray, np.ndarray]:
        """For every bit of the bytes: how often a zero and a one followed the context there; ``group`` numbers the contexts."""
        lengths = code.lengths[byte]
        total = int(lengths.sum())
        zeros, ones = np.zeros(total, np.float32), np.zeros(total, np.float32)
        at = np.cumsum(lengths) - lengths
        low, high = self.start[group], self.start[group + 1]
        for depth in range(code.bits.shape[1]):
            live = np.flatnonzero((lengths > depth) & (high > low))
            if not len(live):
                break
            if len(live) < len(low):
                group, byte, lengths, at, low, high = (x[live] for x in (group, byte, lengths, at, low, high))
            border = code.borders[:, depth][byte]
            cut = low + (self.rank[low] < border)
            many = np.flatnonzero(high - low > 1)
            cut[many] = np.searchsorted(self.place, (group[many] << 8) | border[many])
            middle = self.before[cut]
            zeros[at], ones[at] = middle - self.before[low], self.before[high] - middle
            one = code.bits[:, depth][byte] > 0
            low, high, at = np.where(one, cut, low), np.where(one, high, cut), at + 1
        return zeros, ones


@dataclass
class Evidence:
    """One predictor's logits at every bit of a bucket's pairs of context and byte, which were seen, and each place's first bit."""

    first: np.ndarray
    logit: np.ndarray
    seen: np.ndarray

    @classmethod
    def of(cls, pair: np.ndarray, which: np.ndarray, answer: tuple[np.ndarray, np.ndarray, np.ndarray], code: Code) -> Evidence:
        """``pair`` and ``which`` are those of ``pairs_of``; ``answer`` what followed the contexts, in the order of their keys."""
        context, byte = pair >> _EIGHT, code.by_rank[(pair & np.uint64(255)).astype(np.uint8)]
        new = np.zeros(len(pair), np.int64)
        new[1:] = context[1:] != context[:-1]
        group = np.cumsum(new)
        if len(answer[0]) != (group[-1] + 1 if len(group) else 0):
            raise RuntimeError(f"{len(answer[0])} answers for {group[-1] + 1} contexts")
        lengths = code.lengths[byte]
        logit, seen = np.empty(int(lengths.sum()), np.float32), np.empty(int(lengths.sum()), bool)
        first = np.cumsum(lengths) - lengths
        followers = Followers.of(*answer)
        for a in range(0, len(pair), STEP):
            zeros, ones = followers.counted(group[a : a + STEP], byte[a : a + STEP], code)
            bits = slice(first[a], first[a] + len(zeros))
            logit[bits], seen[bits] = logits(zeros, ones), zeros + ones > 0
        return cls(first.astype(np.int32 if len(logit) < 1 << 31 else np.int64).take(which), logit, seen)


@dataclass
class Model:
    """What scoring a bucket needs: weights and map, and each predictor's evidence at the bucket's places."""

    fixed: Fixed
    evidence: list[Evidence]

    def place_scores(self, places: Places) -> np.ndarray:
        """log10 probability of the byte at each place."""
        code, out, all_ = self.fixed.code, np.zeros(len(places.key)), places.byte
        for start in range(0, len(out), STEP):
            byte = all_[start : start + STEP]
            lengths = code.lengths[byte]
            owner = np.repeat(np.arange(len(byte)), lengths)
            depth = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            bit = code.bits.ravel().take((byte.astype(np.int64) * code.bits.shape[1]).take(owner) + depth)
            inputs, longest = np.empty((PREDICTORS, len(owner)), np.float32), np.zeros(len(owner), np.int8)
            for k, known in enumerate(self.evidence):
                at = known.first[start : start + STEP].take(owner) + depth
                inputs[k] = known.logit.take(at)
                np.maximum(longest, known.seen.take(at).view(np.int8) * np.int8(k + 1), out=longest)
            gate = gates(longest, depth == 0)
            mixed = mixed_logit(inputs, self.fixed.weights, gate)
            cell = cells(gate, mixed)
            p = refined(mixed, self.fixed.map_ones.take(cell), self.fixed.map_all.take(cell))
            out[start : start + STEP] = np.bincount(owner, np.log10(np.where(bit > 0, p, 1 - p)), len(byte))
        return out


def wire(context: np.ndarray, shards: int) -> np.ndarray:
    """Key of a hashed context: its shard, 32 bits of it within the shard, and eight bits left free."""
    spread = mix(context)
    return (shard_of(spread, shards) << np.uint64(40)) | ((spread & _LOW32) << _EIGHT)


def shard_of(spread: np.ndarray, shards: int) -> np.ndarray:
    """Shard of a hash; shards are in the order of the hashes."""
    return (spread >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes: lengths, then first bytes, second bytes and so on of each array's numbers, compressed."""
    lengths = np.array([len(a) for a in arrays], np.int64).tobytes()
    planes = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays if len(a))
    return lengths + pa.Codec("zstd").compress(planes, asbytes=True)


def unpacked(data: bytes, *kinds: str) -> list[np.ndarray]:
    """The arrays of ``packed``."""
    lengths, sizes = np.frombuffer(data, np.int64, len(kinds)), [np.dtype(k).itemsize for k in kinds]
    whole = int((lengths * sizes).sum())
    planes = pa.Codec("zstd").decompress(data[8 * len(kinds) :], decompressed_size=whole, asbytes=True) if whole else b""
    out, at = [], 0
    for n, size, kind in zip(lengths.tolist(), sizes, kinds, strict=True):
        out.append(np.ascontiguousarray(np.frombuffer(planes, np.uint8, n * size, at).reshape(size, n).T).view(kind).reshape(n))
        at += n * size
    return out


def pairs_of(places: Places, code: Code, shards: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each predictor its number, the distinct pairs of context and byte (key with the byte's rank) in order, and each place's.

    A shorter context is part of the next longer one, so its pairs are found among those.
    """
    some, which = places, None
    for k in [PREDICTORS - 1, *reversed(range(len(ORDERS)))]:
        key = wire(some.contexts(k), shards) | code.ranks[some.byte]
        order, first = _groups(key)
        own = np.empty(len(key), np.int32)
        own[order] = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.append(first, len(key))))
        at = order[first]
        if k == PREDICTORS - 1:
            yield k, key[at], own
            continue
        which = own if which is None else own[which]
        yield k, key[at], which
        some = some.take(at)


def asked(pair: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """For each shard what a bucket asks of it and adds to it for a predictor: keys with ranks of bytes in order, and numbers."""
    yield from _by_shard(pair, n, pair >> np.uint64(40), _LOW40)


def asked_words(words: np.ndarray, trains: np.ndarray, shards: int) -> Iterator[tuple[int, bytes]]:
    """The same of hashed words, in any order and often; ``trains`` says which of them count."""
    trained, times = np.unique(words[trains], return_counts=True)
    words = _distinct(words)
    count = np.zeros(len(words), np.int64)
    count[np.searchsorted(words, trained)] = times
    yield from _by_shard(words, count, shard_of(words, shards), ~np.uint64(0))


def _by_shard(key: np.ndarray, n: np.ndarray, shard: np.ndarray, kept: np.uint64) -> Iterator[tuple[int, bytes]]:
    at = np.flatnonzero(np.diff(shard, prepend=shard[:1] + np.uint64(1))).tolist()
    for a, b in zip(at, [*at, len(key)][1:], strict=True):
        yield int(shard[a]), packed(np.diff(key[a:b] & kept, prepend=np.uint64(0)), n[a:b].astype("<u8"))


def answers(parts: list[tuple[int, bytes]], free: int) -> tuple[dict[int, bytes], int, int]:
    """For each bucket what followed its contexts in all of ``parts`` (bucket, what it asked); numbers of all and of different keys.

    ``free`` is the number of bits of a key that don't belong to the context.
    """
    shift = np.uint64(free)
    got = [(bucket, *unpacked(data, "<u8", "<u8")) for bucket, data in parts]
    got = [(bucket, np.cumsum(steps, dtype=np.uint64), n) for bucket, steps, n in got]
    key, n = np.concatenate([k for _, k, _ in got]), np.concatenate([x for _, _, x in got])
    order, first = _groups(key)
    key, n = key[order[first]], np.add.reduceat(n[order], first)
    key, n = key[n > 0], n[n > 0]
    context = key >> shift
    of_bucket: dict[int, list] = {}
    for bucket, k, _ in got:
        of_bucket.setdefault(bucket, []).append(k >> shift)
    out = {}
    for bucket, own in of_bucket.items():
        own = _distinct(np.concatenate(own))
        low = np.searchsorted(context, own)
        size = np.searchsorted(context, own, "right") - low
        at = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        out[bucket] = packed(size.astype("<u4"), (key[at] & np.uint64(255 if free else 0)).astype("u1"), n[at])
    return out, int(n.sum()), len(n)


def _bucketed(docs: DataFrame, size: int) -> DataFrame:
    """``docs`` (held_out, text, doc_id), written once in buckets of about ``size`` bytes of neighbouring texts.

    A row of each task without a bucket has how often each byte stands in its training texts, and their number.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, filled = TaskContext.get().partitionId() << 32, 0
        history = np.zeros(257, np.int64)
        names = ["bucket", "held_out", "text", "doc_id", "history"]
        for batch, data, offsets in blocks(batches):
            n = batch.num_rows
            trains = ~np.array(batch.column(0).to_pylist(), bool)
            history[:256] += np.bincount(lowered(data)[np.repeat(trains, np.diff(offsets))], minlength=256)
            history[256] += trains.sum()
            at = filled + offsets + 16 * np.arange(n + 1)  # rows without a text take room too
            filled = int(at[-1])
            columns = [pa.array(base + at[:-1] // size, pa.int64()), *batch.columns[:3], pa.nulls(n, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names)
        if history.any():
            nulls = [pa.nulls(1, t) for t in (pa.int64(), pa.bool_(), pa.string(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*nulls, pa.array([history.tolist()], pa.list_(pa.int64()))], names)

    rows = docs.mapInArrow(run, "bucket bigint, held_out boolean, text string, doc_id bigint, history array<bigint>")
    return written(rows, "mixing-texts")


def _gathered(rows: DataFrame, code: Code, shards: int) -> DataFrame:
    """(bucket, shard, predictor, asked) of all buckets, and a row of each task with what it learned.

    ``rows`` has (bucket, held_out, text).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = Learner(code)
        kinds = {"bucket": pa.int64(), "shard": pa.int64(), "predictor": pa.int32(), "asked": pa.binary(), "rest": pa.list_(pa.float64())}

        def sent(bucket: int, parts: list[Places], words: list[tuple]) -> Iterator[pa.RecordBatch]:
            places = Places.joined(parts)
            learner.learn(places)
            counted = [(k, list(asked(pair, np.bincount(which, places.n)))) for k, pair, which in pairs_of(places, code, shards)]
            counted.append((WORDS, list(asked_words(np.concatenate([w for w, _ in words]), np.concatenate([n for _, n in words]), shards))))
            for k, found in counted:
                n = len(found)
                columns = [[bucket] * n, [s for s, _ in found], [k] * n, [x for _, x in found], [None] * n]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], list(kinds))

        held, parts, words = None, [], []
        for batch, data, offsets in blocks(batches, size=BATCH):
            buckets = batch.column(0).to_numpy(zero_copy_only=False)
            trains = ~np.array(batch.column(1).to_pylist(), bool)
            data = lowered(data)
            edges = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(buckets)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if held is not None and buckets[a] != held:
                    yield from sent(held, parts, words)
                    parts, words = [], []
                held = int(buckets[a])
                some = data[offsets[a] : offsets[b]]
                starts, ends, before = words_of(some, offsets[a : b + 1] - offsets[a])
                plain, text_at, token_at = plain_bytes(some, starts, ends, before)
                length = np.diff(np.append(text_at, len(plain)))
                places, hashes = places_and_words(plain, text_at, token_at, np.repeat(trains[a:b], length))
                put(parts, places)
                words.append((hashes, np.repeat(trains[a:b], np.diff(before))))
        if held is not None:
            yield from sent(held, parts, words)
        if learner.n_bits:
            columns = [[None], [None], [None], [None], [learner.rest().tolist()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], list(kinds))

    return rows.select("bucket", "held_out", "text").mapInArrow(
        run, "bucket bigint, shard bigint, predictor int, asked binary, rest array<double>"
    )


def _answered(sent: DataFrame) -> DataFrame:
    """(bucket, shard, predictor, answer, tokens, types, rest): what followed the contexts that a bucket asked for, in the training texts of all.

    One row of a shard of words has the numbers of its training words and of different ones. What the
    tasks learned goes through.
    """
    learned = "rest" in sent.columns
    kinds = {
        "bucket": pa.int64(), "shard": pa.int64(), "predictor": pa.int32(), "answer": pa.binary(),
        "tokens": pa.int64(), "types": pa.int64(), "rest": pa.list_(pa.float64()),
    }

    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard, k = (x.as_py() for x in key)
        if shard is None:
            return pa.table({c: table.column(c) if c == "rest" else pa.nulls(table.num_rows, t) for c, t in kinds.items()})
        parts = list(zip(table.column("bucket").to_pylist(), table.column("asked").to_pylist(), strict=True))
        out, tokens, types = answers(parts, 0 if k == WORDS else 8)
        n = len(out)
        totals = [[x if k == WORDS else None, *[None] * (n - 1)] for x in (tokens, types)]
        columns = [list(out), [shard] * n, [k] * n, list(out.values()), *totals, [None] * n]
        return pa.table({c: pa.array(x, t) for (c, t), x in zip(kinds.items(), columns, strict=True)})

    found = sent.groupBy("shard", "predictor").applyInArrow(
        run, "bucket bigint, shard bigint, predictor int, answer binary, tokens bigint, types bigint, rest array<double>"
    )
    return found if learned else found.drop("rest")


def _totals(answered: DataFrame) -> tuple[int, int]:
    """Numbers of all training words and of different ones."""
    return tuple(answered.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first())


def _word_totals(sent: DataFrame) -> tuple[int, int]:
    """The same from what the buckets asked."""
    return _totals(_answered(sent.filter(F.col("predictor") == WORDS)))


def mixed_shares(spelled: np.ndarray, share: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """log10 probability of each of ``n`` texts: the mean over ``SHARES`` of mixing spelling (log10) and share that way."""
    spelling = 10 ** np.maximum(spelled, -300)
    sums = np.stack([np.bincount(owner, np.log10((1 - x) * spelling + x * share), n) for x in SHARES])
    best = sums.max(axis=0)
    return best + np.log10((10 ** (sums - best)).mean(axis=0))


def scored(docs: DataFrame, folds: int = 10, text: str = "text", size: int | None = None) -> DataFrame:
    """Word-model and mixing scores of every text; documents of the held-out fold train nothing.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes (predicted
    bytes; -score * log2(10) / n_bytes are the bits per byte). Null texts are empty: one end token. A
    null id is held out. Rows that share an id or a text are texts of their own; other columns are
    left out. ``size`` bytes of text make a bucket, which one task scores. An empty table gives no rows.
    """
    need(docs, "doc_id", text)
    spark = docs.sparkSession
    rows = _bucketed(
        docs.select(
            held_out(F.col("doc_id"), folds).alias("held_out"),
            F.col(text).cast("string").alias("text"),
            F.col("doc_id").cast("bigint").alias("doc_id"),
        ),
        size or BUCKET,
    )
    history = np.zeros(257, np.int64)
    for byte, n in rows.filter("bucket IS NULL").select(F.posexplode("history")).groupBy("pos").agg(F.sum("col")).collect():
        history[byte] = n
    ends, shards = int(history[256]), max(1, -(-int(history[:256].sum()) // SHARD))
    spaces = [*range(9, 14), _SPACE]
    between = history[spaces].sum()
    history[spaces] = 0
    history[[_SPACE, _END]] = between, ends
    code = Code.of(history[:256])
    rows = rows.filter("bucket IS NOT NULL").drop("history")
    # what the buckets asked is shuffled once and stored nowhere; its shuffle files go when the answers are there
    with shuffles_dropped(spark):
        answered = written(_answered(_gathered(rows, code, shards)), "mixing-answers")
    rest = np.zeros(1 + GATES * PREDICTORS + 2 * GATES * CELLS)
    for place, value in answered.filter("rest IS NOT NULL").select(F.posexplode("rest")).groupBy("pos").agg(F.sum("col")).collect():
        rest[place] = value
    fixed = spark.sparkContext.broadcast(Fixed.of(code, rest))
    tokens, types = _totals(answered)
    tokens, types = tokens + ends, types + (ends > 0)

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = {
            "doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(),
            "train_tokens": pa.int64(), "base_score": pa.float64(), "score": pa.float64(), "n_bytes": pa.int64(),
        }
        got: dict[int, list] = {}
        order = np.lexsort((right.column("shard").to_numpy(), right.column("predictor").to_numpy()))
        for k, answer in zip(right.column("predictor").to_numpy()[order].tolist(), right.column("answer").take(pa.array(order)).to_pylist(), strict=True):
            got.setdefault(k, []).append(unpacked(answer, "<u4", "u1", "<u8"))
        del right
        texts, parts = [], []
        for batch, data, offsets in blocks(iter(left.to_batches()), size=BATCH):
            data = lowered(data)
            starts, ends_, before = words_of(data, offsets)
            plain, text_at, token_at = plain_bytes(data, starts, ends_, before)
            places, which = places_of(plain, text_at, token_at)
            put(parts, places)
            n_bytes = np.diff(np.append(text_at, len(plain)))
            # each word of the batch once, and which of them comes where
            word_of = which.take(word_ends(len(plain), token_at))
            used = np.zeros(len(places.key), bool)
            used[word_of] = True
            word_of = (np.cumsum(used, dtype=np.int32) - np.int32(1)).take(word_of)
            texts.append((batch.select(["doc_id", "held_out"]), mix(places.word[used]), word_of, np.diff(before), n_bytes, token_at, which, places.key))
        places = Places.joined(parts)
        del parts, left, batch, data, plain
        for i, (*kept, keys) in enumerate(texts):
            texts[i] = (*kept, np.searchsorted(places.key, keys).astype(np.int32))
        evidence: list = [None] * PREDICTORS
        for k, pair, own in pairs_of(places, fixed.value.code, shards):
            evidence[k] = Evidence.of(pair, own, tuple(np.concatenate(x) for x in zip(*got.pop(k), strict=True)), fixed.value.code)
        each = Model(fixed.value, evidence).place_scores(places)
        del evidence
        words = _distinct(np.concatenate([t[1] for t in texts]))
        found = [np.concatenate(x) for x in zip(*got.pop(WORDS), strict=True)] if len(words) else [np.zeros(0, np.uint32)] * 3
        c_of = np.zeros(len(words), np.int64)
        c_of[found[0] > 0] = found[2]
        whole = -np.log10(tokens + 0.1 * (types + 1))
        out = []
        for batch, hashes, word_of, n_words, n_bytes, token_at, which, at in texts:
            n = len(n_words)
            owner = np.repeat(np.arange(n), n_words)
            c = c_of.take(np.searchsorted(words, hashes)).take(word_of)
            base = np.bincount(owner, np.log10(c + 0.1) + whole, n) + np.log10(ends + 0.1) + whole
            spelled = np.add.reduceat(each.take(at).take(which), token_at)
            count = np.full(len(token_at), ends, np.float64)
            count[np.arange(len(c)) + owner] = c
            score = mixed_shares(spelled, count / max(1, tokens), np.repeat(np.arange(n), n_words + 1), n)
            known = np.bincount(owner, c > 0, n).astype(np.int64) + (ends > 0)
            columns = [batch.column(0), batch.column(1), n_words + 1, known, np.full(n, tokens), base, score, n_bytes]
            out.append(pa.table({name: pa.array(x, kind) if isinstance(x, np.ndarray) else x for (name, kind), x in zip(kinds.items(), columns, strict=True)}))
        return pa.concat_tables(out)

    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, n_bytes bigint"
    answered = answered.filter("bucket IS NOT NULL").select("bucket", "shard", "predictor", "answer")
    return rows.groupBy("bucket").cogroup(answered.groupBy("bucket")).applyInArrow(run, schema)


def op3_context_mixing(spark, sf_dir: str) -> DataFrame:
    """Both scores of every document, learned outside the held-out tenth."""
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
