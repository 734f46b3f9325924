"""Mixing sources to target weights over training time (operator 4, native).

A source's weight may change while training runs. Its schedule is integrated into a
cumulative demand of tokens; the documents of the source, laid end to end in a fixed
pseudo-random order and repeated as often as needed, meet that demand; and inverting it
gives each copy of a document its training position between 0 and 1. Documents are then
range-sorted by position.

Prefix sums never put a source into one task: documents of a source are dealt to about
N / 2048 consecutive ranges of a hash, and offsets are summed over ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clearspan.llm.common import native_words, need, written

#: Copies of a document that a mix may take.
MAX_EPOCHS = 3
_COARSE_BITS = 8
_RANGE_ROWS = 2048
#: A document is long if it holds more than one part in so many of its source's words.
_LONG = 1000

#: A piece of a source's demand curve, linear in its rate: from time t0 to t1 the rate
#: goes from r0 to r1 tokens for the whole training time; d0 tokens were asked for before.
SEGMENT = "struct<t0:double,t1:double,r0:double,r1:double,d0:double>"


def source_key(source: Column) -> Column:
    """A text key of a source that keeps null apart from every name."""
    return F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source.cast("string")))


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    """One small row for each document: doc_id, source, its key, size in words and order hash.

    Null text has size 0. The hash depends on the id and the text only, so that reruns agree.
    """
    need(docs, "doc_id", "source", text)
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        source_key(F.col("source")).alias("skey"),
        F.size(native_words(F.col(text))).cast("bigint").alias("size"),
        F.xxhash64(F.lit(4), F.col("doc_id"), F.xxhash64(F.col(text))).bitwiseAND(F.lit((1 << 63) - 1).cast("bigint")).alias("u"),
    )


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), cap: int = MAX_EPOCHS) -> DataFrame:
    """Target of every source: its share by weight of all sizes, at most ``cap`` times its size.

    Sources by code point, null last, take the weights in turn. What a full source cannot
    take is reshared by weight: with sources ordered by how early they fill up, the level
    is (total - caps of the full ones) / (weights of the others). One row for each source
    meets in one task here; documents never do. No rows give no rows.
    """
    one = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy("fill", "skey")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    totals = sizes.groupBy("source", "skey").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    turn = (F.row_number().over(one) - 1) % len(weights)
    rows = totals.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn))
    rows = rows.withColumn("cap", F.col("source_size") * cap).withColumn("fill", F.col("cap") / F.col("weight"))
    rows = rows.select(
        "*",
        F.sum("source_size").over(everything).alias("total"),
        F.sum("weight").over(everything).alias("all_weight"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("cap_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("weight_before"),
    )
    # the level if exactly the sources before this one are full; the first that stays below its cap fixes it
    level = (F.col("total") - F.col("cap_before")) / (F.col("all_weight") - F.col("weight_before"))
    rows = rows.withColumn("level_if", level)
    fits = F.when(F.col("level_if") <= F.col("fill"), F.col("level_if"))
    rows = rows.withColumn("level", F.min(F.struct(fits.isNull(), F.col("fill"), F.col("skey"), fits.alias("level"))).over(everything)["level"])
    target = F.when(F.col("level").isNull(), F.col("cap").cast("double")).otherwise(
        F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    )
    return rows.select("source", "skey", "source_size", "n_docs", "weight", "total", target.alias("target"))


def ramp(sources: DataFrame) -> DataFrame:
    """Knots of a curriculum that starts near natural proportions and leans towards the wanted ones.

    A source with share q of all words and share p of the mix has weight p + a (p - q) (2 t - 1)
    at time t, with the largest a up to 1 that keeps every weight from falling below 0. Weights
    add up to 1 at any time, and each source's integral is p.
    """
    everything = Window.partitionBy(F.lit(1))
    # without any word nothing is taken, whatever the weights
    p, q = (F.coalesce(F.try_divide(F.col(c).cast("double"), F.col("total")), F.lit(0.0)) for c in ("target", "source_size"))
    slack = F.when(p != q, p / F.abs(p - q)).otherwise(1.0)
    rows = sources.withColumn("_a", F.least(F.lit(1.0), F.min(slack).over(everything)))
    lean = F.col("_a") * (p - q)
    knots = F.array(
        F.struct(F.lit(0.0).alias("t"), F.greatest(p - lean, F.lit(0.0)).alias("weight")),
        F.struct(F.lit(1.0).alias("t"), F.greatest(p + lean, F.lit(0.0)).alias("weight")),
    )
    return rows.select("skey", F.explode(knots).alias("k")).select("skey", "k.t", "k.weight")


def integrated(sources: DataFrame, knots: DataFrame) -> DataFrame:
    """``sources`` with ``segments``: the demand curve of each, scaled to reach its target at time 1.

    ``knots`` has (skey, t, weight): a piecewise linear schedule, with at least two knots for
    a source. A source without knots, or without weight, is asked for evenly.
    """
    order = Window.partitionBy("skey").orderBy("t")
    pieces = knots.select("skey", "t", "weight", F.lead("t").over(order).alias("t1"), F.lead("weight").over(order).alias("w1"))
    pieces = pieces.filter("t1 > t").withColumn("area", (F.col("t1") - F.col("t")) * (F.col("weight") + F.col("w1")) / 2)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("done", F.coalesce(F.sum("area").over(before), F.lit(0.0)))
    curves = pieces.groupBy("skey").agg(
        F.sum("area").alias("area"), F.sort_array(F.collect_list(F.struct("t", "t1", "weight", "w1", "done"))).alias("pieces")
    )
    even = F.array(F.struct(F.lit(0.0), F.lit(1.0), F.col("target"), F.col("target"), F.lit(0.0))).cast(f"array<{SEGMENT}>")
    scale = F.col("target") / F.col("area")
    scaled = F.transform(
        "pieces", lambda x: F.struct(x["t"], x["t1"], x["weight"] * scale, x["w1"] * scale, x["done"] * scale)
    ).cast(f"array<{SEGMENT}>")
    rows = sources.join(curves, "skey", "left")
    return rows.withColumn("segments", F.when(F.col("area") > 0, scaled).otherwise(even)).drop("area", "pieces")


def time_of(segments: Column, demand: Column) -> Column:
    """When cumulative demand reaches ``demand``: the inverse of the demand curve, from 0 to 1."""
    at = F.element_at(F.filter(segments, lambda s: (s["d0"] <= demand) | (s["t0"] <= 0)), -1)
    left, span = F.greatest(demand - at["d0"], F.lit(0.0)), at["t1"] - at["t0"]
    slope = (at["r1"] - at["r0"]) / span
    root = F.sqrt(F.greatest(at["r0"] * at["r0"] + 2 * slope * left, F.lit(0.0)))
    step = F.when(at["r0"] + root > 0, 2 * left / (at["r0"] + root)).otherwise(0.0)
    return F.least(F.lit(1.0), at["t0"] + F.least(span, step))


def _long_copies(rows: DataFrame, cap: int) -> DataFrame:
    """How often each long document is taken (``k``): the nearest whole number of copies that keeps the running sum on course.

    Long documents go by falling size, so that smaller ones make up for the rounding of larger
    ones. A source has fewer than ``_LONG`` of them, as each holds more than that part of its words.
    """
    item = F.struct("size", "u", "doc_id")
    lists = rows.groupBy("skey").agg(
        F.sort_array(F.collect_list(item), asc=False).alias("items"), F.first("target").alias("target"), F.first("source_size").alias("source_size")
    )
    zero = F.struct(F.lit(0.0).alias("due"), F.array().cast("array<int>").alias("ks"))

    def step(a: Column, x: Column) -> Column:
        due = a["due"] + x["size"] * F.col("target") / F.col("source_size")
        k = F.greatest(F.lit(0), F.least(F.lit(cap), F.round(due / x["size"]).cast("int")))
        return F.struct((due - k * x["size"]).alias("due"), F.concat(a["ks"], F.array(k)).alias("ks"))

    counts = F.aggregate("items", zero, step, lambda a: a["ks"])
    out = lists.select("skey", F.explode(F.arrays_zip(F.col("items").alias("item"), counts.alias("k"))).alias("x"))
    return out.select("skey", "x.item.size", "x.item.u", "x.item.doc_id", "x.k")


def mixed(docs: DataFrame, knots=ramp, cap: int = MAX_EPOCHS, text: str = "text") -> DataFrame:
    """One row for each document with ``copies``: its copies in the mix and their training positions.

    Columns: skey, doc_id, size, source_size, target, u, copies (array of epoch, position).
    The few long documents of a source are dealt first, nearest to their share; the others are laid
    end to end and taken until the rest of the target is met: a copy is in the mix if its middle lies
    before that. So a source misses its target by half of its shorter documents at most, if it has
    such. Documents without words are never taken. ``knots`` makes the schedule from the source table.

    Rows that agree in id, source and text are alike: they get neighbouring places in any order.
    An empty table gives no rows.
    """
    rows = written(sized(docs, text), "mix-sizes")
    sources = written(targets(rows, cap=cap), "mix-sources")
    curves = integrated(sources, knots(sources)).select("skey", "source_size", "target", "segments")
    n_docs = sources.agg(F.sum("n_docs")).first()[0] or 0
    fine = max(1, n_docs // (1 << _COARSE_BITS) // _RANGE_ROWS)
    low = 63 - _COARSE_BITS

    known = rows.join(sources.select("skey", "source_size", "target"), "skey")
    is_long = F.col("size") * _LONG > F.col("source_size")
    long = written(_long_copies(known.filter(is_long), cap), "mix-long")
    dealt = long.groupBy("skey").agg(F.sum("size").alias("long_size"), F.sum(F.col("size") * F.col("k")).alias("long_taken"))
    curves = curves.join(dealt, "skey", "left").na.fill(0, ["long_size", "long_taken"])
    curves = curves.withColumn("short_size", F.col("source_size") - F.col("long_size"))
    left = F.greatest(F.lit(0.0), F.col("target") - F.col("long_taken"))
    curves = curves.withColumn("short_target", F.least(left, cap * F.col("short_size").cast("double")))

    long = long.join(curves.select("skey", "source_size", "target", "segments"), "skey")
    chance = F.col("u") / float(1 << 63)
    ks = F.when(F.col("k") > 0, F.sequence(F.lit(0), F.col("k") - 1)).otherwise(F.array().cast("array<int>"))
    long = long.select(
        "skey", "doc_id", "size", "source_size", "target", "u",
        F.transform(
            ks,
            lambda e: F.struct(e.alias("epoch"), time_of(F.col("segments"), (e + chance) / F.col("k") * F.col("target")).alias("position")),
        ).alias("copies"),
    )

    short = known.filter(~is_long).drop("source_size", "target").withColumn("coarse", F.shiftright("u", low))
    part = F.col("u").bitwiseAND(F.lit((1 << low) - 1).cast("bigint")) / float(1 << low)
    short = short.withColumn("fine", F.floor(part * fine))
    ranges = short.groupBy("skey", "coarse", "fine").agg(F.sum("size").alias("tokens"))
    inner = Window.partitionBy("skey", "coarse").orderBy("fine")
    outer = Window.partitionBy("skey").orderBy("coarse")
    coarse = ranges.groupBy("skey", "coarse").agg(F.sum("tokens").alias("tokens"))
    coarse = coarse.select("skey", "coarse", (F.sum("tokens").over(outer) - F.col("tokens")).alias("ahead"))
    ranges = ranges.withColumn("inside", F.sum("tokens").over(inner) - F.col("tokens"))
    ranges = ranges.join(coarse, ["skey", "coarse"]).join(curves, "skey")
    ranges = ranges.select(
        "skey", "coarse", "fine", (F.col("ahead") + F.col("inside")).alias("offset"),
        "source_size", "target", "segments", "short_size", "short_target",
    )
    place = Window.partitionBy("skey", "coarse", "fine").orderBy("u", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    short = short.join(ranges, ["skey", "coarse", "fine"])
    short = short.withColumn("first", F.col("offset") + F.sum("size").over(place) - F.col("size"))
    stretch = F.col("target") / F.col("short_target")
    copies = F.transform(
        F.sequence(F.lit(0), F.lit(cap - 1)),
        lambda e: F.struct(e.alias("epoch"), (e * F.col("short_size") + F.col("first") + F.col("size") / 2).alias("middle")),
    )
    taken = F.filter(copies, lambda c: (F.col("size") > 0) & (c["middle"] <= F.col("short_target")))
    short = short.withColumn("_taken", taken).select(
        "skey", "doc_id", "size", "source_size", "target", "u",
        F.transform(
            "_taken", lambda c: F.struct(c["epoch"], time_of(F.col("segments"), c["middle"] * stretch).alias("position"))
        ).alias("copies"),
    )
    return long.unionByName(short)


def training_order(docs: DataFrame, mix: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the mix takes, once for each copy, range-sorted by training position.

    The columns are those of ``docs``. Rows meet their mix by id and order hash, so rows with one
    id and different texts stay apart; wholly equal rows are taken equally often.
    """
    own = list(docs.columns)
    keyed = docs.select(
        F.struct(*[F.col(c) for c in own]).alias("_row"),
        source_key(F.col("source")).alias("_s"),
        F.xxhash64(F.lit(4), F.col("doc_id"), F.xxhash64(F.col(text))).bitwiseAND(F.lit((1 << 63) - 1).cast("bigint")).alias("_u"),
    )
    # wholly equal rows are taken equally often, by their mean; no more than one row's copies is held of them
    per = mix.groupBy(F.col("skey").alias("_s"), F.col("u").alias("_u")).agg(
        F.round(F.sum(F.size("copies")) / F.count(F.lit(1))).cast("int").alias("_n"), F.max("copies").alias("_copies")
    )
    at = F.slice(F.transform("_copies", lambda c: c["position"]), F.lit(1), F.col("_n"))
    taken = keyed.join(per.filter("_n > 0").withColumn("_at", at), ["_s", "_u"])
    out = taken.select("_row", F.explode("_at").alias("_position")).orderBy("_position")
    return out.select(*[F.col("_row").getField(c).alias(c) for c in own])


def op4_mix_sources(spark, sf_dir: str) -> DataFrame:
    """How often the mix takes every document of ``documents``, range-sorted by first training position."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    mix = mixed(docs)
    taken = (F.size("copies") * F.col("size")).cast("bigint")
    first = F.get("copies", 0)["position"]
    rows = mix.select(
        "doc_id", "size", "source_size", "target", taken.alias("taken"), first.alias("first_position"), "copies", "u"
    )
    # documents that are not taken have no position: spread behind the others, not all in one range
    return rows.orderBy(F.coalesce("first_position", 1 + F.col("u") / float(1 << 63))).drop("u")
