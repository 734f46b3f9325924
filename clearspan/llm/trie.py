"""Prefix trie of conversations by van Emde Boas recursion (operator 13).

A conversation is a sequence of turns, a turn a token of 24 bytes (hash of role and text, and the
text's length). Sequences are cut at half depth. The cut prefix gets a name, a hash of its root's name and of
what lies between; upper halves then form the upper trie and lower halves a forest below the
names, and both are cut again in the same job, until blocks are one turn deep. After each cut equal
halves under one root become one row with the number of its conversations and their smallest id, combined before
the shuffle, so shared prefixes are carried once and a prefix that a third of all conversations
share costs one row for each task.

Sequences of more than ``WIDTH`` turns are cut into blocks of that many, a block is a token of the tier above, and the
recursion begins there: no row ever holds more than ``WIDTH`` tokens, however long a conversation
is, and the number of rounds is the logarithm of the longest.

Totals go upward along the cuts. A node adds its own to the roots of the lower halves it lies in (as many
as its depth has binary digits), and the sum that arrives at a cut node is grafted onto that node and
the nodes above it in the upper half it ends, whose names follow from that half's tokens.

Names are 128-bit hashes; all else is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearspan.llm.common import let, need, written
from clearspan.operators.skew import global_row_number

#: Tokens of a sequence that one row holds at most; a power of two.
WIDTH = 64
#: Bytes of a token: 16 of its hash, 8 of a number.
TOKEN = 24
#: First turns that a conversation can take over, and conversations that share them.
HEAD, FAMILY = 6, 100
#: Conversation ids that are joined into one text before the digest reads them.
CHUNK = 4096

#: Name of the root.
ROOT = bytes(16)


def _hash(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def _part(seq: Column, start: Column | int, n: Column | int) -> Column:
    """``n`` tokens of a sequence from token ``start`` on."""
    return F.substring(seq, F.lit(TOKEN) * start + 1, F.lit(TOKEN) * n)


def _length(seq: Column) -> Column:
    return (F.octet_length(seq) / TOKEN).cast("int")


def _number(token: Column) -> Column:
    """The number in the last 8 bytes of a token."""
    return F.conv(F.hex(F.substring(token, 17, 8)), 16, 10).cast("bigint")


def _token(content: Column, number: Column) -> Column:
    return F.concat(F.unhex(F.md5(content)), F.unhex(F.lpad(F.hex(number.cast("bigint")), 16, "0")))


def _named(root: Column, seq: Column, n: Column | int) -> Column:
    """Name of the node ``n`` tokens of ``seq`` below ``root``: one hash for each binary digit of ``n``.

    These are the names that the cuts give, as a block is cut at its half and the lower half again.
    """
    start = F.struct(root.alias("name"), F.lit(0).alias("at"))
    bits = F.array(*[F.lit(WIDTH >> k) for k in range(WIDTH.bit_length())])
    step = lambda a, b: F.when(
        F.lit(n).bitwiseAND(b) > 0, F.struct(_hash(a["name"], _part(seq, a["at"], b)).alias("name"), (a["at"] + b).alias("at"))
    ).otherwise(a)
    return F.aggregate(bits, start, step, lambda a: a["name"])


# ---------------------------------------------------------------- sequences


def taken_over(conv_id: Column) -> Column:
    """How many first turns a conversation takes over: unsigned crc32 of its decimal id, modulo 6."""
    return F.crc32(conv_id.cast("string").cast("binary")) % HEAD


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id) of all conversations, and (conv_id, pos, token) of the rebuilt ones' turns.

    Turns are in order of turn (null first), then role, then text; null roles and texts are empty. Rows without a
    conversation id belong to none and are left out. Equal rows are turns of their own. Turns are
    numbered along a range sort, so one conversation may hold any share of the rows.
    """
    need(turns, "conv_id", "turn", "role", "text")
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    content = F.concat(F.octet_length("role").cast("string").cast("binary"), F.lit(b":"), F.col("role").cast("binary"), F.col("text").cast("binary"))
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    numbered = global_row_number(rows, order, "number").select("conv_id", "number", _token(content, F.length("text")).alias("token"))
    numbered = written(numbered, "trie-turns")
    convs = numbered.groupBy("conv_id").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("n"))
    placed = numbered.join(convs.select("conv_id", "first"), "conv_id").select("conv_id", (F.col("number") - F.col("first")).alias("pos"), "token")
    # a family's first turns: at most five rows, for at most a hundred conversations
    heads = (
        placed.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEAD - 1))
        .groupBy("conv_id")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "token"))), lambda x: x["token"]).alias("head"))
        .withColumnRenamed("conv_id", "base")
    )
    known = convs.select("conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), taken_over(F.col("conv_id")).alias("h"), "n")
    known = known.join(heads, "base", "left").select(
        "conv_id", "h", F.slice(F.coalesce("head", F.array().cast("array<binary>")), F.lit(1), F.col("h").cast("int")).alias("head")
    )
    known = written(known, "trie-conversations")
    shift = known.filter(F.size("head") < F.col("h")).select("conv_id", (F.size("head") - F.col("h")).alias("shift"))
    own = placed.filter(F.col("pos") >= taken_over(F.col("conv_id"))).join(shift, "conv_id", "left")
    own = own.select("conv_id", (F.col("pos") + F.coalesce("shift", F.lit(0))).alias("pos"), "token")
    first = known.select("conv_id", F.posexplode("head").alias("pos", "token")).select("conv_id", F.col("pos").cast("bigint").alias("pos"), "token")
    return known.select("conv_id"), first.unionByName(own)


def _blocks(tokens: DataFrame) -> DataFrame:
    """(conv_id, block, seq): the tokens of each conversation in rows of ``WIDTH``."""
    pairs = F.sort_array(F.collect_list(F.struct("pos", "token")))
    joined = F.aggregate(pairs, F.lit(b""), lambda a, x: F.concat(a, x["token"]))
    return tokens.groupBy("conv_id", F.floor(F.col("pos") / WIDTH).cast("bigint").alias("block")).agg(joined.alias("seq"))


def tiers_of(tokens: DataFrame) -> list[DataFrame]:
    """Blocks of turns, blocks of blocks, and so on; the last has one block for each conversation.

    A token of a higher tier names the block below by its hash and holds the number of its tokens.
    """
    tiers = [written(_blocks(tokens), "trie-blocks")]
    while (tiers[-1].agg(F.max("block")).first()[0] or 0) > 0:
        above = tiers[-1].select("conv_id", F.col("block").alias("pos"), _token(F.col("seq"), _length(F.col("seq"))).alias("token"))
        tiers.append(written(_blocks(above), "trie-blocks"))
    return tiers


# ---------------------------------------------------------------- the recursion


def _halves(width: int) -> Column:
    """The row's block of up to ``width`` tokens as its upper half and, if it goes beyond, its lower half."""
    half, n, seq = width // 2, _length(F.col("seq")), F.col("seq")
    whole, first = n == width, _part(F.col("seq"), 0, width // 2)
    # what is known of the block's end is known of the lower half's end, if the block is whole
    end = [F.when(whole, F.col(c)).alias(c) for c in ("name", "top", "path")]

    def cut(name: Column) -> Column:
        upper = F.struct(
            F.col("depth").alias("depth"), F.col("root").alias("root"), F.col("roots").alias("roots"), first.alias("seq"),
            F.when(n >= half, name).alias("name"), F.when(n >= half, F.col("root")).alias("top"), F.when(n >= half, first).alias("path"),
        )
        lower = F.struct(
            (F.col("depth") + half).alias("depth"), name.alias("root"), F.concat(F.col("roots"), F.array(name)).alias("roots"),
            F.substring(seq, TOKEN * half + 1, TOKEN * half).alias("seq"), *end,
        )
        return F.when(n > half, F.array(upper, lower)).otherwise(F.array(upper))

    return let(_hash(F.col("root"), first), cut)


def halved(rows: DataFrame, width: int) -> DataFrame:
    """Cut sequences of up to ``width`` tokens down to single ones.

    ``rows``: depth (in tokens, of the root), root, roots (of the lower halves so far), seq, name (of the end, if the
    block is full), top and path (root and tokens of the upper half that ends there), n, conv_id. The result has the same columns
    with one token in ``seq``: a row for each node.
    """
    keys = ["depth", "root", "roots", "seq", "name", "top", "path"]
    while width > 1:
        rows = rows.select(F.explode(_halves(width)).alias("h"), "n", "conv_id").select(*[f"h.{k}" for k in keys], "n", "conv_id")
        rows = rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"))
        width //= 2
    return rows


def _start(seq: Column, width: int) -> list[Column]:
    """Name, root and tokens of a block's end, if it is full."""
    full = _length(seq) == width
    return [F.when(full, _hash(F.lit(ROOT), seq)).alias("name"), F.when(full, F.lit(ROOT)).alias("top"), F.when(full, seq).alias("path")]


def named_nodes(tiers: list[DataFrame]) -> list[DataFrame]:
    """For each tier the nodes at the ends of its tokens, by the recursion from the highest tier down."""
    longest = tiers[-1].agg(F.max(_length(F.col("seq")))).first()[0] or 0
    width = 1 << max(0, longest - 1).bit_length()
    start = tiers[-1].select(
        F.lit(0).cast("bigint").alias("depth"), F.lit(ROOT).alias("root"), F.array().cast("array<binary>").alias("roots"), "seq",
        *_start(F.col("seq"), width), F.lit(1).cast("bigint").alias("n"), "conv_id",
    )
    start = start.groupBy("depth", "root", "roots", "seq", "name", "top", "path").agg(F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"))
    out: list[DataFrame] = []
    for t in range(len(tiers) - 1, -1, -1):
        nodes = written(halved(start, width), "trie-nodes")
        out.insert(0, nodes)
        if t:
            # a token's name leads to its tokens; equal blocks of all conversations are one row
            below = tiers[t - 1].groupBy("seq").agg(F.count(F.lit(1)).alias("_n")).select("seq", _token(F.col("seq"), _length(F.col("seq"))).alias("token"))
            full = _length(F.col("below.seq")) == WIDTH
            start = (
                nodes.alias("up").join(below.alias("below"), F.col("up.seq") == F.col("below.token"))
                .select(
                    (F.col("up.depth") * WIDTH).alias("depth"), F.col("up.root").alias("root"), F.col("up.roots").alias("roots"), F.col("below.seq").alias("seq"),
                    F.when(full, F.col("up.name")).alias("name"), F.when(full, F.col("up.root")).alias("top"), F.when(full, F.col("below.seq")).alias("path"),
                    F.col("up.n").alias("n"), F.col("up.conv_id").alias("conv_id"),
                )
            )
            width = WIDTH
    return out


def _half_above() -> Column:
    """Names of the nodes of the half (or block) that ends at a node, the node itself last."""
    n = _length(F.col("path"))
    return F.transform(F.sequence(F.lit(1), n), lambda k: F.when(k < n, _named(F.col("top"), F.col("path"), k)).otherwise(F.col("name")))


def grafted(nodes: list[DataFrame], own: DataFrame, values: list[str]) -> DataFrame:
    """(name, ``values``): what lies below each node, for nodes with anything below them.

    ``own`` has (name, roots, ``values``) of every node. ``nodes`` are those of each tier, for the upper halves that end at a node.
    """
    sums = [F.sum(v).alias(v) for v in values]
    below = own.select(F.explode("roots").alias("name"), *values).groupBy("name").agg(*sums)
    total = None
    for t in range(len(nodes) - 1, -1, -1):
        paths = nodes[t].filter("path IS NOT NULL").select("name", "top", "path", (_length(F.col("path")) == WIDTH).alias("whole"))
        here = below.join(paths.filter("NOT whole"), "name")
        if total is not None:
            # ends of whole blocks: what the tier above has brought there goes to all nodes of the block
            here = here.unionByName(total.join(paths.filter("whole"), "name"))
        total = here.select(F.explode(_half_above()).alias("name"), *values).groupBy("name").agg(*sums)
    return total


def ends_of(convs: DataFrame, tiers: list[DataFrame], lengths: DataFrame) -> DataFrame:
    """(conv_id, name): the node at which each conversation ends."""
    rows = convs.join(lengths, "conv_id", "left").select("conv_id", F.coalesce("length", F.lit(0)).alias("length"), F.lit(ROOT).alias("name"))
    for t in range(len(tiers) - 1, -1, -1):
        unit, top = WIDTH**t, t == len(tiers) - 1
        at = F.floor(F.col("length") / unit)
        # full tokens of this tier in the conversation's last block (all, in the highest tier)
        n = at if top else at % WIDTH
        block = F.lit(0) if top else F.floor(F.col("length") / (unit * WIDTH))
        rows = rows.withColumn("block", block.cast("bigint")).withColumn("n", n.cast("int"))
        rows = rows.join(tiers[t], ["conv_id", "block"], "left").select(
            "conv_id", "length", F.when(F.col("n") > 0, _named(F.col("name"), F.col("seq"), F.col("n"))).otherwise(F.col("name")).alias("name")
        )
    return rows.select("conv_id", "name")


def digests(ends: DataFrame) -> DataFrame:
    """(name, ends_sha256): SHA-256 of the decimal ids of the conversations that end at a node, ascending, comma-joined.

    Ids are joined in ranges of ``CHUNK`` before the shuffle's last step. The digest of one node is a
    chain, so its texts are read in order by one task, but streamed: only the digest's state is held.
    """
    part = F.floor(F.col("conv_id") / CHUNK).cast("bigint")
    texts = ends.groupBy("name", part.alias("part")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, state = None, None
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for key, ids in zip(batch["name"], batch["ids"], strict=True):
                if key == name:
                    state.update(b"," + ids.encode())
                    continue
                if state is not None:
                    done.append((name, state.hexdigest()))
                name, state = key, hashlib.sha256(ids.encode())
            yield pd.DataFrame(done, columns=["name", "ends_sha256"])
        if state is not None:
            yield pd.DataFrame([(name, state.hexdigest())], columns=["name", "ends_sha256"])

    return texts.repartition("name").sortWithinPartitions("name", "part").mapInPandas(run, "name binary, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """A row for each node of the trie of rebuilt conversations.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. The root has
    depth 0 and all conversations, also those without a turn after rebuilding. An empty table, or one
    without any conversation id, has no root and no rows. Other columns of ``turns`` play no part.
    """
    convs, tokens = rebuilt(turns)
    tiers = tiers_of(tokens)
    nodes = named_nodes(tiers)
    kids = nodes[0].groupBy("root").agg(F.count(F.lit(1)).alias("n_children")).withColumnRenamed("root", "name")
    known = nodes[0].select("name", "root", "roots", (F.col("depth") + 1).alias("depth"), "conv_id", "n", _number(F.col("seq")).alias("length"))
    known = known.join(kids, "name", "left").select(
        "name", "root", "roots", "depth", "conv_id", F.col("n").alias("n_convs"), F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("n_children").isNull().cast("bigint").alias("leaves"), ((F.col("n") - 1) * F.col("length")).alias("saved"),
    )
    known = written(known, "trie-known")
    below = grafted(nodes, known, ["leaves", "saved"])
    inner = known.join(below.select("name", F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved")), "name", "left").select(
        "name", "root", "depth", "conv_id", "n_convs", "n_children",
        (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"), (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
    )
    # one row: the root has every conversation, and what all nodes have
    all_nodes = known.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.sum((F.col("depth") == 1).cast("bigint")).alias("kids"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").crossJoin(F.broadcast(all_nodes))
    root = root.select(
        F.lit(ROOT).alias("name"), F.lit(None).cast("binary").alias("root"), F.lit(0).cast("bigint").alias("depth"), "conv_id", "n_convs",
        F.coalesce("kids", F.lit(0)).alias("n_children"), F.coalesce("leaves", F.lit(1)).alias("n_leaves"), F.coalesce("saved", F.lit(0)).alias("saved_tokens"),
    )
    rows = inner.unionByName(root)
    parents = known.select(F.col("name").alias("root"), F.col("conv_id").alias("parent_conv_id")).unionByName(
        root.select(F.col("name").alias("root"), F.col("conv_id").alias("parent_conv_id"))
    )
    lengths = tokens.groupBy("conv_id").agg(F.count(F.lit(1)).alias("length"))
    ends = digests(ends_of(convs, tiers, lengths))
    none = hashlib.sha256(b"").hexdigest()
    return (
        rows.join(parents, "root", "left").join(ends, "name", "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
    )


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """The prefix trie of all ``conversations``."""
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))


#: DuckDB SQL of ``op13_prefix_trie``; the crc32 is taken byte by byte.
OP13_SQL = """
WITH RECURSIVE bytes AS (
  SELECT conv_id, 1 AS k, CAST(conv_id AS VARCHAR) AS s, CAST(4294967295 AS BIGINT) AS crc
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
  UNION ALL
  SELECT conv_id, k + 1, s, list_reduce([xor(crc, CAST(ascii(s[k:k]) AS BIGINT)), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)
  FROM bytes WHERE k <= length(s)
), conv AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(crc, 4294967295) % 6 AS h FROM bytes WHERE k = length(s) + 1
), own AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), o.turns[c.h + 1:len(o.turns)]) AS turns
  FROM conv c JOIN own o USING (conv_id) LEFT JOIN own b ON b.conv_id = c.base
), prefix AS (
  SELECT r.conv_id, d.d, r.turns[1:d.d] AS turns, len(r.turns) = d.d AS ends
  FROM rebuilt r CROSS JOIN (SELECT unnest(range(0, (SELECT max(len(turns)) FROM rebuilt) + 1)) AS d) d
  WHERE d.d <= len(r.turns)
), node AS (
  SELECT turns, CAST(any_value(d) AS BIGINT) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ids
  FROM prefix GROUP BY turns
), kids AS (
  SELECT turns[1:len(turns) - 1] AS turns, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1
), known AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children, CASE WHEN k.n IS NULL THEN 1 ELSE 0 END AS leaf,
    CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(n.turns[len(n.turns)].text) END AS saved
  FROM node n LEFT JOIN kids k USING (turns)
), below AS (
  SELECT k.turns[1:d.d] AS turns, sum(k.leaf) AS n_leaves, sum(k.saved) AS saved_tokens
  FROM known k CROSS JOIN (SELECT unnest(range(0, (SELECT max(depth) FROM node) + 1)) AS d) d
  WHERE d.d <= k.depth GROUP BY 1
)
SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves,
  CAST(b.saved_tokens AS BIGINT) AS saved_tokens, sha256(k.ids) AS ends_sha256
FROM known k JOIN below b USING (turns) LEFT JOIN known p ON k.depth > 0 AND p.turns = k.turns[1:k.depth - 1]
"""
