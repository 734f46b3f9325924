"""Quality rules as a ledger of failure bits (operator 5, native).

Every rule is evaluated once for every document and leaves one bit and the numbers
behind it. Policies are versioned sets of rules: applying one, or asking what a rule
changes, reads only the bits and never a text again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearspan.llm.common import SPACES, let, native_words, need


@dataclass(frozen=True)
class Rule:
    """A rule: its bit in the ledger, and the condition under which a document fails, over the measurements."""

    name: str
    bit: int
    fails: str


#: Failure conditions over the measurements. The first two are the base rules.
RULES = (
    Rule("few_words", 0, "n_words < 10"),
    Rule("repeated_words", 1, "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", 2, "10 * n_symbols > n_words"),
    Rule("word_length", 3, "word_chars < 2 * n_words OR word_chars > 12 * n_words"),
    Rule("duplicate_lines", 4, "n_dup_lines >= 3 AND 2 * n_dup_lines > n_lines"),
    Rule("few_letters", 5, "2 * n_letters < word_chars"),
    Rule("stutter", 6, "100 * n_stutter > 30 * n_words"),
)

#: Versioned policies: a document is rejected if it fails one of the named rules.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols"),
    "v2": tuple(r.name for r in RULES),
}

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_letters", "n_stutter", "n_repeat_words")
WINDOW = 5


def mask(names: tuple[str, ...]) -> int:
    """The bits of the named rules."""
    bits = {r.name: r.bit for r in RULES}
    return sum(1 << bits[n] for n in set(names))


def _repeated(windows: Column) -> Column:
    """Words covered by windows that occur twice or more; ``windows`` holds a hash for each start."""

    def covered(s: Column) -> Column:
        again = F.filter(
            s,
            lambda x, j: ((j > 0) & (F.get(s, j - 1)["h"] == x["h"])) | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)),
        )
        starts = F.sort_array(F.transform(again, lambda x: x["i"]))
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(
            starts,
            zero,
            lambda a, p: F.struct((a["n"] + p + WINDOW - F.greatest(p, a["end"])).alias("n"), (p + WINDOW).alias("end")),
            lambda a: a["n"],
        )

    by_hash = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(let(by_hash, covered))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measurements of every whole text, all long.

    A null text has no words, lines or symbols. Windows of five words are compared by
    64-bit hashes. Columns of ``docs`` that clash with a measurement are replaced.
    """
    need(docs, text)
    raw = F.coalesce(F.col(text), F.lit(""))
    own = F.struct(*[F.col(c) for c in docs.columns]).alias("_row")
    step = docs.select(
        own,
        native_words(raw).alias("_w"),
        F.length(F.regexp_replace(raw, SPACES, "")).alias("_chars"),
        F.length(F.regexp_replace(raw, r"[^#*$%&|<>]+", "")).alias("_symbols"),
        F.length(F.regexp_replace(raw, r"\P{L}+", "")).alias("_letters"),
        F.filter(F.split(raw, "\n"), lambda x: F.trim(F.translate(x, "\t\x0b\x0c\r", "    ")) != "").alias("_lines"),
    )
    n = F.size("_w")
    step = step.select(
        "*",
        n.alias("_n"),
        F.when(
            n >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(F.col("_w"), i + k) for k in range(WINDOW)])
            ),
        )
        .otherwise(F.array().cast("array<bigint>"))
        .alias("_windows"),
        F.when(
            n >= 2,
            F.size(F.filter(F.sequence(F.lit(1), n - 1), lambda i: F.get(F.col("_w"), i) == F.get(F.col("_w"), i - 1))),
        )
        .otherwise(0)
        .alias("_stutter"),
    )
    values = {
        "n_words": F.col("_n"),
        "word_chars": F.col("_chars"),
        "n_symbols": F.col("_symbols"),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_letters": F.col("_letters"),
        "n_stutter": F.col("_stutter"),
        "n_repeat_words": _repeated(F.col("_windows")),
    }
    kept = [F.col("_row").getField(c).alias(c) for c in docs.columns if c not in values]
    return step.select(*kept, *[v.cast("bigint").alias(k) for k, v in values.items()])


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without their text, with the measurements and ``fail_bits``: a bit for each rule that fails."""
    rows = measured(docs, text)
    return rows.select(*[c for c in rows.columns if c not in (text, "fail_bits")], _bits().alias("fail_bits"))


def _bits() -> Column:
    bits = F.lit(0).cast("bigint")
    for rule in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << rule.bit).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return bits


def passes(policy: str, bits: str = "fail_bits") -> Column:
    """Whether a document passes every rule of a policy."""
    return F.col(bits).bitwiseAND(F.lit(mask(POLICIES[policy])).cast("bigint")) == 0


def ablations(rows: DataFrame, policy: str, by: list[str] | None = None) -> DataFrame:
    """What each rule of a policy changes: a row for each rule, and for each group of ``by``.

    ``n_failed`` documents fail the rule; ``n_only`` fail no other rule of the policy, so
    dropping the rule would keep them. ``any_bits`` and ``all_bits`` are the rules that
    some and that all documents of the group fail. The ledger is first counted by its
    bits, at most 2 to the number of rules for a group.
    """
    by, wanted = by or [], mask(POLICIES[policy])
    counted = rows.groupBy(*by, F.col("fail_bits").bitwiseAND(F.lit(wanted).cast("bigint")).alias("bits")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_or("fail_bits").alias("seen"), F.bit_and("fail_bits").alias("common")
    )
    names = [r for r in RULES if wanted >> r.bit & 1]
    rule = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("bigint").alias("bit")) for r in names]))
    out = counted.select("*", rule.alias("r")).select(*by, "bits", "n", "seen", "common", "r.rule", "r.bit")
    return out.groupBy(*by, "rule").agg(
        F.sum("n").alias("n_docs"),
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.bit_or("seen").alias("any_bits"),
        F.bit_and("common").alias("all_bits"),
    )


def filtered(docs: DataFrame, policy: str = "v2", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass a policy, with their own columns only."""
    rows = measured(docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_doc"), F.col(text).alias("_text")), "_text")
    # the running number keeps Spark from moving the filter, and with it every measurement, below the projections
    rows = rows.select("_doc", _bits().alias("fail_bits"), F.monotonically_increasing_id().alias("_at"))
    kept = rows.filter(passes(policy) & (F.col("_at") >= 0))
    return kept.select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns])


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    """The ledger of ``documents`` with the base verdict and that of the newest policy."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = ledger(docs)
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~passes("base")).alias("base_failed"),
        passes("v2").alias("kept"),
        "fail_bits",
    )


#: DuckDB SQL of ``op5_quality_rules``.
OP5_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM d
), g AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n
  FROM (SELECT rid, i, list_slice(w, i, i + 4) AS g FROM w, unnest(range(1, len(w) - 3)) AS t(i))
), r AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM g, unnest(range(0, 5)) AS t(k) WHERE n > 1 GROUP BY rid
), m AS (
  SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(regexp_replace(text, '\P{L}', '', 'g')) AS BIGINT) AS n_letters,
    CAST(len(l) AS BIGINT) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(len(list_filter(range(2, len(w.w) + 1), lambda i: w.w[i] = w.w[i - 1])) AS BIGINT) AS n_stutter,
    CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN r USING (rid)
), b AS (
  SELECT *, CAST(
    (CASE WHEN n_words < 10 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words OR word_chars > 12 * n_words THEN 8 ELSE 0 END)
    + (CASE WHEN n_dup_lines >= 3 AND 2 * n_dup_lines > n_lines THEN 16 ELSE 0 END)
    + (CASE WHEN 2 * n_letters < word_chars THEN 32 ELSE 0 END)
    + (CASE WHEN 100 * n_stutter > 30 * n_words THEN 64 ELSE 0 END) AS BIGINT) AS fail_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits
FROM b
"""
