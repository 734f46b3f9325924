"""Exact n-gram Jaccard join by a token-group matrix (operator 6).

Documents are sets of hashed word shingles. Equal sets are one node. A hash splits each set
into more parts than two sets at the threshold can differ in elements, so any two such sets
agree wholly in a part that is not empty (pigeonhole). The hash of a part is a token of the
matrix; only sets with a token that another set also has go on.

Two sets at the threshold have many tokens in common, at least as many as the smaller of their full parts exceeds the
elements in which they can differ; a set that needs k leaves its k - 1 most common tokens out and still has one in common with each
that it links with.

These sets are partitioned into groups of similar ones: each goes with its most shared token that is left,
and large groups are split. The matrix says which group holds which token. Sets of one group
are compared in one task call. Then each set whose tokens are elsewhere too meets one hub group, and the components are joined: of
a family of near copies that fills many groups, groups meet a hub, not each other. Only groups with sets still apart are opened
for each other: a set goes there only if it has as many tokens in the stored union of the other group's as it needs,
and in the call is bounded again by its overlap with the union of the shingles that came. Calls return links that join components, not
pairs. No candidate is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clearspan.llm.common import need, written
from clearspan.llm.components import components
from clearspan.llm.spans import blocks, buffer_of, hash_spans, lowered, mix, windows, words_of

#: Sets in a group on average, where a group is split.
GROUP = 256
#: Sets that meet a hub group in one call.
GUESTS = 1024
#: Wishes that are held against a group's union in one call.
WISHES = 4096
#: Turns of hubs at most, before groups are opened for each other.
TURNS = 8
#: Largest bit map of shared tokens, as a power of two bits: 16 MiB.
MAP_BITS = 27

def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and for each text the number before it.

    Words in lower case (A-Z); a text with fewer than ``n`` words has one shingle, without words none.
    """
    data = lowered(data)
    starts, ends, before = words_of(data, offsets)
    runs, at = windows(hash_spans(data, starts, ends), before, n)
    parts = [np.unique(runs[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    return (np.concatenate(parts) if parts else runs), np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)]).astype(np.int64)


class Bands:
    """Size bands, and for each the number of parts and how many must not be empty.

    Band i holds sizes from ``starts[i]`` to ``starts[i + 1] - 1``. Sets that link with a set of band i
    lie in it or in the low end of the next, up to ``tops[i]``; all of these are split under key i. Two
    such sets differ in ``differ[i]`` elements at most, so with more parts that are not empty, one agrees.
    """

    def __init__(self, num: int, den: int, largest: int):
        if 2 * num <= den:
            raise ValueError("sets at a threshold of a half or less can differ in as many elements as they have")
        self.starts = [1]
        while self.starts[-1] <= largest:
            low = self.starts[-1]
            # narrow enough that the least set has more elements than two sets of the band can differ in
            wide = -(-low * num // (den - num)) if den > num else low * 2
            self.starts.append(max(low + 1, min(wide, -(-low * 5 * den // (4 * num)))))
        tops, differ, parts = [], [], []
        for low, high in zip(self.starts[:-1], self.starts[1:], strict=True):
            tops.append((high - 1) * den // num)
            differ.append((high - 1 + tops[-1]) * (den - num) // (den + num))
            need_full = differ[-1] + 1
            k = need_full
            # enough parts that a set of the least size leaves too few full ones only by rare chance
            while need_full > 1 and k < 4 * need_full:
                empty = k * np.exp(-low / k)
                if k - empty - 2 * np.sqrt(empty) >= need_full:
                    break
                k += max(1, k // 64)
            parts.append(k)
        self.tops, self.differ, self.parts = np.array(tops), np.array(differ), np.array(parts)

    def keys(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(set, key) of every key that each set is split under."""
        own = np.searchsorted(self.starts, sizes, "right") - 1
        also = np.flatnonzero((own > 0) & (sizes <= self.tops[np.maximum(own, 1) - 1]))
        return np.concatenate([np.arange(len(sizes)), also]), np.concatenate([own, own[also] - 1])


def part_tokens(shingles: np.ndarray, at: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set, token) for every part that is not empty, of sets given in a row with the number before each; and each set's need.

    The need is the least number of tokens that a set has in common with any set at the threshold: the parts that are not
    empty, less those in which the two can differ, and one at least.

    Should a set have too few such parts under a hash, it is split again under the next one, and goes by
    both: of two sets at the threshold, the first hash that suffices for either gives a common token.
    """
    sizes = np.diff(at)
    full = np.flatnonzero(sizes)
    need = np.ones(len(sizes), np.int64)
    if not len(full):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), need
    bands = Bands(num, den, int(sizes.max()))
    which, key = bands.keys(sizes[full])
    owner = full[which]
    out_set, out_token = [], []
    seed = 0
    while len(owner):
        n, k = sizes[owner], bands.parts[key]
        first = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(first - at[:-1][owner], n)
        spread = mix(shingles[place] ^ mix(np.full(1, seed + 11, np.uint64)))
        start = np.cumsum(k) - k
        cell = np.repeat(start, n) + (((spread >> np.uint64(32)) * np.repeat(k, n).astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        total = int(k.sum())
        count = np.bincount(cell, minlength=total)
        value = mix(spread)
        low = np.bincount(cell, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), total).astype(np.uint64)
        high = np.bincount(cell, (value >> np.uint64(32)).astype(np.float64), total).astype(np.uint64)
        entry = np.repeat(np.arange(len(owner)), k)
        some = np.flatnonzero(count)
        e = entry[some]
        name = (key[e].astype(np.uint64) << np.uint64(40)) + (some - start[e]).astype(np.uint64) + (np.uint64(seed) << np.uint64(56))
        out_set.append(owner[e])
        out_token.append(mix((low[some] + (high[some] << np.uint64(32))) ^ mix(name)))
        agree = np.bincount(e, minlength=len(owner)) - bands.differ[key]
        if seed == 0:
            least = np.full(len(sizes), np.iinfo(np.int64).max)
            np.minimum.at(least, owner, agree)
            need[full] = np.maximum(1, least[full])
        enough = agree > 0
        owner, key, seed = owner[~enough], key[~enough], seed + 1
    return np.concatenate(out_set), np.concatenate(out_token), need


def _nodes(shingles: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of each set; 0 for sets without elements."""
    sizes = np.diff(at)
    full = sizes > 0
    out = np.zeros(len(sizes), np.uint64)
    if full.any():
        spread = mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5))
        out[full] = mix(np.add.reduceat(spread, at[:-1][full]) ^ sizes[full].astype(np.uint64))
    return out


def _all_tokens(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(token, node) of every document's set; a block of texts gives the least and the largest node of a token only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in blocks(batches):
            shingles, at = shingle_sets(data, offsets, n)
            owner, tokens, _ = part_tokens(shingles, at, num, den)
            nodes = _nodes(shingles, at)[owner].view(np.int64)
            order = np.lexsort((nodes, tokens))
            tokens, nodes = tokens[order].view(np.int64), nodes[order]
            first = np.ones(len(tokens), bool)
            first[1:] = tokens[1:] != tokens[:-1]
            last = np.append(first[1:], True)[: len(tokens)]
            keep = first | last
            yield pa.RecordBatch.from_arrays([pa.array(tokens[keep], pa.int64()), pa.array(nodes[keep], pa.int64())], ["token", "node"])

    return docs.select("text").mapInArrow(run, "token bigint, node bigint")


def bit_map(tokens: DataFrame) -> tuple[np.ndarray, int]:
    """A map of 2 ** bits bits with two bits set for each token; its size is bounded, whatever the tokens' number.

    Fewer than 16 MiB: beyond eleven million tokens it lets more foreign ones pass, which the join that
    follows turns away.
    """
    n = tokens.count()
    bits = min(MAP_BITS, max(16, int(12 * n).bit_length()))
    mask = F.lit((1 << bits) - 1).cast("bigint")
    both = F.array(F.col("token").bitwiseAND(mask), F.shiftright("token", 32).bitwiseAND(mask))
    words = tokens.select(F.explode(both).alias("at")).groupBy(F.shiftright("at", 6).alias("word"))
    found = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("set")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found.column("word").to_numpy()] = found.column("set").to_numpy().view(np.uint64)
    return out, bits


def in_map(tokens: np.ndarray, words: np.ndarray, bits: int) -> np.ndarray:
    """Whether a bit map has both places of each token."""
    hit = np.ones(len(tokens), bool)
    for place in (tokens & ((1 << bits) - 1), (tokens >> 32) & ((1 << bits) - 1)):
        hit &= (words[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1)) > 0
    return hit


def _sketches(docs: DataFrame, n: int, num: int, den: int, shared: tuple[np.ndarray, int]) -> DataFrame:
    """(key, doc_id, n, node, need, tokens) of every document: size and hash of its set, its need, and its tokens that may be shared."""
    words, bits = docs.sparkSession.sparkContext.broadcast(shared[0]), shared[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches):
            shingles, at = shingle_sets(data, offsets, n)
            sizes = np.diff(at)
            owner, tokens, need = part_tokens(shingles, at, num, den)
            signed = tokens.view(np.int64)
            hit = in_map(signed, words.value, bits)
            owner, signed = owner[hit], signed[hit]
            order = np.argsort(owner, kind="stable")
            cuts = np.searchsorted(owner[order], np.arange(len(sizes) + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(cuts, pa.array(signed[order], pa.int64()))
            nodes = _nodes(shingles, at).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64(), mask=sizes == 0), pa.array(need, pa.int64()), lists],
                ["key", "doc_id", "n", "node", "need", "tokens"],
            )

    return docs.select("key", "doc_id", "text").mapInArrow(run, "key bigint, doc_id bigint, n bigint, node bigint, need bigint, tokens array<bigint>")


def _texts(docs: DataFrame, wanted: tuple[np.ndarray, int]) -> DataFrame:
    """(key, text) of the documents whose key is in a bit map, and of a few others. Texts are packed closer than sets of hashes."""
    words, bits = docs.sparkSession.sparkContext.broadcast(wanted[0]), wanted[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_map(batch.column(0).to_numpy(zero_copy_only=False), words.value, bits)))

    return docs.select("key", "text").mapInArrow(run, "key bigint, text string")


def _set_list(table: pa.Table, n: int) -> list[np.ndarray]:
    """Shingle sets of a table's texts."""
    shingles, at = shingle_sets(*buffer_of(table.column("text").combine_chunks()), n)
    return [shingles[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


class _Forest:
    """Disjoint sets of small numbers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, by products over the tokens that both sides have."""
    a, b = np.concatenate(left), np.concatenate(right)
    tokens = np.intersect1d(a, b)
    out = np.zeros((len(left), len(right)), np.float32)
    if not len(tokens):
        return out.astype(np.int64)

    def sparse(parts: list[np.ndarray], flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        at = np.minimum(np.searchsorted(tokens, flat), len(tokens) - 1)
        hit = tokens[at] == flat
        return owner[hit], at[hit]

    (ro, rt), (co, ct) = sparse(left, a), sparse(right, b)
    for lo in range(0, len(tokens), 4096):
        hi = min(len(tokens), lo + 4096)
        x, y = np.zeros((len(left), hi - lo), np.float32), np.zeros((len(right), hi - lo), np.float32)
        m = (rt >= lo) & (rt < hi)
        x[ro[m], rt[m] - lo] = 1
        m = (ct >= lo) & (ct < hi)
        y[co[m], ct[m] - lo] = 1
        out += x @ y.T
    return out.astype(np.int64)


def _linked(left: list[np.ndarray], right: list[np.ndarray], num: int, den: int) -> Iterator[tuple[int, int]]:
    """Pairs of a left and a right set at or above the threshold."""
    if len(left) == 1 and len(right) == 1:
        o, a, b = len(np.intersect1d(left[0], right[0], assume_unique=True)), len(left[0]), len(right[0])
        if den * o >= num * (a + b - o):
            yield 0, 0
        return
    sizes_l, sizes_r = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    for a in range(0, len(left), 1024):
        o = _overlaps(left[a : a + 1024], right)
        ok = den * o >= num * (sizes_l[a : a + 1024, None] + sizes_r[None, :] - o)
        for i, j in zip(*np.nonzero(ok), strict=True):
            yield a + int(i), int(j)


def _inside(n: int, num: int, den: int):
    """Links inside a group: every set with the least node of its component there."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        nodes = table.column("node").to_pylist()
        forest = _Forest(len(nodes))
        if len(nodes) > 1:
            sets = _set_list(table, n)
            if len(nodes) == 2:
                if any(_linked(sets[:1], sets[1:], num, den)):
                    forest.join(0, 1)
            else:
                for i, j in _linked(sets, sets, num, den):
                    if i < j:
                        forest.join(i, j)
        roots = [nodes[forest.root(k)] for k in range(len(nodes))]
        return pa.table({"node": pa.array(nodes, pa.int64()), "part": pa.array(roots, pa.int64())})

    return run


def _between(n: int, num: int, den: int):
    """Links between two opened groups, as pairs of components that they join."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        side, part = table.column("side").to_pylist(), table.column("part").to_pylist()
        sets = _set_list(table, n)
        number = {p: k for k, p in enumerate(sorted(set(part)))}
        names = sorted(number)
        found: list[tuple[int, int]] = []
        left = [k for k, s in enumerate(side) if s == 0]
        right = [k for k, s in enumerate(side) if s == 1]

        def qualifying(own: list[int], other: list[int]) -> list[int]:
            """Sets whose overlap with the union of the other group's tokens can reach the threshold."""
            if not own or not other:
                return []
            union = np.unique(np.concatenate([sets[k] for k in other]))
            out = []
            for k in own:
                at = np.minimum(np.searchsorted(union, sets[k]), len(union) - 1)
                if den * int((union[at] == sets[k]).sum()) >= num * len(sets[k]):
                    out.append(k)
            return out

        left = qualifying(left, right)
        right = qualifying(right, left)
        if left and right:
            forest = _Forest(len(names))
            for i, j in _linked([sets[k] for k in left], [sets[k] for k in right], num, den):
                a, b = number[part[left[i]]], number[part[right[j]]]
                if forest.join(a, b):
                    found.append((names[a], names[b]))
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})

    return run


def _matrix(rare: DataFrame, placed: DataFrame) -> DataFrame:
    """(token, gid, low, high, held): for each token and group with it the least and the largest component of its sets there, and their number."""
    cells = rare.join(placed, "node").groupBy("token", "gid")
    return written(cells.agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count(F.lit(1)).alias("held")), "token-group-matrix")


def _hub_sides(rare: DataFrame, placed: DataFrame, turn: int) -> DataFrame:
    """(ga, gb, side, node): every set with a token in other components against one hub group that has its most common such token.

    The first hub of a token is the group with the most sets of it, later ones change with the turn. A set travels once a
    turn. Those of one hub are dealt to calls of ``GUESTS``, each with the hub's own sets.
    """
    matrix = _matrix(rare, placed)
    hub = F.struct("gid", "low", "high")
    first = F.struct("held", "gid") if turn == 0 else F.struct(F.xxhash64(F.lit(turn), "gid"), F.col("gid"))
    hubs = matrix.groupBy("token").agg(F.max_by(hub, first).alias("hub"), F.min("low").alias("l"), F.max("high").alias("h"), F.count(F.lit(1)).alias("g"))
    hubs = hubs.filter("g > 1 AND l <> h").select("token", "hub")
    away = rare.join(hubs, "token").join(placed, "node").filter("gid <> hub.gid AND NOT (hub.low = hub.high AND hub.low = part)")
    guests = written(away.groupBy("node").agg(F.max_by("hub.gid", F.struct("n", "token")).alias("ga")), "hub-guests")
    calls = guests.groupBy("ga").agg(F.ceil(F.count(F.lit(1)) / GUESTS).cast("bigint").alias("calls"))
    sent = guests.join(calls, "ga").select("ga", F.pmod(F.xxhash64(F.lit(8), "node"), F.col("calls")).alias("gb"), F.lit(1).alias("side"), "node")
    own = placed.select(F.col("gid").alias("ga"), "node").join(calls, "ga")
    zero = F.lit(0).cast("bigint")
    return sent.unionByName(own.select("ga", F.explode(F.sequence(zero, F.col("calls") - 1)).alias("gb"), F.lit(0).alias("side"), "node"))


def _granted(left: pa.Table, right: pa.Table) -> pa.Table:
    """The wishes of sets that have as many tokens in a group's union as they need."""
    lists = left.column("tokens").combine_chunks()
    union = np.unique(right.column("tokens").combine_chunks().flatten().to_numpy())
    flat = lists.flatten().to_numpy()
    at = np.minimum(np.searchsorted(union, flat), max(0, len(union) - 1))
    hits = np.concatenate([[0], np.cumsum(union[at] == flat if len(union) else np.zeros(len(flat), bool))])
    ends = np.cumsum(lists.value_lengths().to_numpy())
    found = hits[ends] - hits[ends - lists.value_lengths().to_numpy()]
    return left.select(["node", "gid", "other"]).filter(pa.array(found >= left.column("need").to_numpy()))


def _open_sides(rare: DataFrame, tokens: DataFrame, placed: DataFrame) -> DataFrame:
    """(ga, gb, side, node) of the groups that still have sets apart and a token in common.

    Each group's tokens, their union, are stored; a set goes to another group only if it has as many tokens in
    that union as it needs, and only if sets of both groups go.
    """
    matrix = _matrix(rare, placed)
    apart = matrix.groupBy("token").agg(F.min("low").alias("l"), F.max("high").alias("h"), F.count(F.lit(1)).alias("g"))
    cells = matrix.join(apart.filter("l <> h AND g > 1").select("token"), "token")
    other = cells.select("token", F.col("gid").alias("other"), F.col("low").alias("lo"), F.col("high").alias("ho"))
    mine = rare.select("node", "token").join(placed, "node")
    wish = mine.join(other, "token").filter("gid <> other AND NOT (lo = ho AND lo = part)")
    wish = written(wish.select("node", "gid", "other").distinct(), "open-wishes")
    # each wish takes its set's tokens to the other group's union, dealt to calls that each have that union
    own = tokens.groupBy("node").agg(F.max("need").alias("need"), F.collect_list("token").alias("tokens"))
    union = tokens.join(placed.select("node", F.col("gid").alias("other")), "node").groupBy("other").agg(F.collect_set("token").alias("tokens"))
    calls = wish.groupBy("other").agg(F.ceil(F.count(F.lit(1)) / WISHES).cast("bigint").alias("calls"))
    dealt = wish.join(own, "node").join(calls, "other").withColumn("call", F.pmod(F.xxhash64(F.lit(9), "node"), F.col("calls"))).drop("calls")
    zero = F.lit(0).cast("bigint")
    union = union.join(calls, "other").select("other", "tokens", F.explode(F.sequence(zero, F.col("calls") - 1)).alias("call"))
    keys = ["other", "call"]
    granted = dealt.groupBy(*keys).cogroup(union.groupBy(*keys)).applyInArrow(_granted, "node bigint, gid bigint, other bigint")
    going = written(granted.select(
        F.least("gid", "other").alias("ga"), F.greatest("gid", "other").alias("gb"), F.when(F.col("gid") < F.col("other"), 0).otherwise(1).alias("side"), "node"
    ), "open-sides")
    both = going.groupBy("ga", "gb").agg(F.min("side").alias("a"), F.max("side").alias("b")).filter("a <> b").select("ga", "gb")
    return going.join(both, ["ga", "gb"])


def similar(docs: DataFrame, n: int = 5, num: int = 8, den: int = 10, text: str = "text") -> DataFrame:
    """(key, doc_id, n, component_id, root): component of every row of ``docs`` under links of Jaccard num / den or more.

    A row's set has its distinct shingles of ``n`` words; ``n`` in the result is its size. Sets without
    tokens (null, empty or white text) link with nothing: their component is their own id. Rows with
    one id are documents of their own; ``component_id`` is the least id in the component, null if it
    has none. Where rows share an id, components may share a ``component_id`` too; ``root`` (null
    without tokens) tells them apart. ``key`` stands for id and text. Hashes have 64 bits.
    """
    need(docs, "doc_id", text)
    doc_id = F.col("doc_id").cast("bigint")
    rows = docs.select(
        F.xxhash64(doc_id.isNull(), doc_id, F.xxhash64(text)).alias("key"), doc_id.alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    every = _all_tokens(rows, n, num, den)
    # combined before the shuffle by blocks, so that rows travel as they are, narrower than partial aggregates
    shared = every.repartition("token").groupBy("token").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a <> b").select("token")
    shared = written(shared, "shared-tokens")
    sketches = written(_sketches(rows, n, num, den, bit_map(shared)), "shingle-sketches")
    nodes = sketches.filter("n > 0")

    held = nodes.select("node", "need", F.explode("tokens").alias("token"))
    tokens = written(held.join(shared, "token").distinct(), "node-tokens")

    # two sets at the threshold share as many tokens as each needs, so also one when each leaves its most common ones out
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("node")
    ranked = tokens.join(counts, "token").select(
        "node", "token", "n", "need", F.row_number().over(own.orderBy("n", "token")).alias("at"), F.count(F.lit(1)).over(own).alias("held")
    )
    rare = written(ranked.filter("at <= held - need + 1").select("node", "token", "n"), "rare-tokens")

    # a group is of one common token, rare or not: the fewer groups a family fills, the fewer have to meet
    group = ranked.filter("need <= held AND at = held").select("node", "token")
    sizes = group.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("pieces"))
    group = group.join(sizes, "token").select(
        "node", F.xxhash64("token", F.pmod(F.xxhash64(F.lit(6), "node"), F.col("pieces"))).alias("gid")
    )
    group = written(group, "groups")

    # one row of each node gives its text; rows equal in id and text have one key
    chosen = nodes.join(group, "node").groupBy("node", "gid").agg(F.min("key").alias("key"))
    chosen = written(chosen, "chosen")
    texts = _texts(rows, bit_map(chosen.select(F.col("key").alias("token"))))
    grouped = written(texts.join(chosen, "key").dropDuplicates(["key"]), "group-texts").drop("key")

    parts = written(grouped.groupBy("gid").applyInArrow(_drop("gid", _inside(n, num, den)), "node bigint, part bigint"), "group-parts")
    placed = written(group.join(parts, "node"), "placed")
    between = _drop("ga", _drop("gb", _between(n, num, den)))

    def linked(sides: DataFrame, placed: DataFrame) -> DataFrame:
        """Components of the groups opened for each other; ``sides`` has (ga, gb, side, node)."""
        sent = sides.join(grouped.select("node", "text"), "node").join(placed.select("node", "part"), "node")
        roots = components(sent.groupBy("ga", "gb").applyInArrow(between, "a bigint, b bigint"))
        moved = placed.join(roots.select(F.col("node").alias("part"), "root"), "part", "left")
        return written(moved.select("node", "gid", F.coalesce("root", "part").alias("part")), "placed")

    def apart(placed: DataFrame) -> int:
        return placed.agg(F.count_distinct("part")).first()[0]

    # as long as a turn joins a good part of what is apart, another costs less than opening groups pair by pair
    left, turn = apart(placed), 0
    while turn < TURNS:
        placed = linked(_hub_sides(rare, placed, turn), placed)
        before, left, turn = left, apart(placed), turn + 1
        if before - left < before / 50:
            break
    placed = linked(_open_sides(rare, tokens, placed), placed)
    parts = placed.select("node", F.col("part").alias("root"))

    least = nodes.groupBy("node").agg(F.min("doc_id").alias("least")).join(parts, "node", "left")
    least = written(least.select("node", F.coalesce("root", "node").alias("root"), "least"), "node-roots")
    best = least.groupBy("root").agg(F.min("least").alias("component_id"))
    found = least.join(best, "root").select("node", "component_id", "root")
    with_words = nodes.select("key", "doc_id", "n", "node").join(found, "node").select("key", "doc_id", "n", "component_id", "root")
    without = sketches.filter("n = 0").select("key", "doc_id", "n", F.col("doc_id").alias("component_id"), F.lit(None).cast("bigint").alias("root"))
    return with_words.unionByName(without)


def _drop(column: str, run):
    """``run`` of a group's table without a key column."""

    def call(table: pa.Table) -> pa.Table:
        return run(table.drop_columns(column))

    return call


def one_of_each(docs: DataFrame, n: int = 5, num: int = 8, den: int = 10, text: str = "text") -> DataFrame:
    """``docs`` with one document of each component of near-duplicates, the one of least id.

    Rows without words stay. Of a component's rows with that id, the one of the least key stays; rows that
    agree in id and text stay once. In components without any id, every row stays, as none stands for the others.
    """
    rows = similar(docs, n, num, den, text)
    doc_id = F.col("doc_id").cast("bigint")
    best = rows.filter((F.col("n") > 0) & F.col("component_id").isNotNull() & F.col("doc_id").eqNullSafe(F.col("component_id")))
    best = best.groupBy("root").agg(F.min("key").alias("_key")).select("_key", F.lit(True).alias("_once"))
    others = rows.filter((F.col("n") == 0) | F.col("component_id").isNull()).select(F.col("key").alias("_key"), F.lit(False).alias("_once"))
    stay = written(best.union(others.distinct()), "stay")
    keyed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"), F.xxhash64(doc_id.isNull(), doc_id, F.xxhash64(text)).alias("_key"))
    # one shuffle of the texts: equal rows meet where they are joined
    tie = F.when(F.col("_once"), F.lit(0).cast("bigint")).otherwise(F.monotonically_increasing_id())
    found = keyed.join(stay.hint("shuffle_hash"), "_key").withColumn("_tie", tie).dropDuplicates(["_key", "_tie"])
    return found.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])


def op6_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Components of all ``documents`` whose sets of three-word shingles reach a Jaccard index of 0.9."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return similar(docs, 3, 9, 10).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


#: DuckDB SQL of ``op6_jaccard_join`` (ids are unique in the tables).
OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS t FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), o AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL
), e AS (
  SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= 90 * (a.n + b.n - o)
), r(doc_id, hop) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.hop = e.x
)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, (SELECT min(hop) FROM r WHERE r.doc_id = w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id)
"""
