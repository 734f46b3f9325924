"""Repeated runs of lines, found by winnowing over line hashes (operator 1).

The corpus is read as lines (split at line feeds; a line's words decide, not its white
space). A window is the shortest run of lines from some line on that holds at least
``min_words`` words. Its fingerprint is the least hash of its lines. Wherever two places
share a run of that many words, they share a window, hence its fingerprint: no repeated run
of ``min_words`` words is missed.

Fingerprints found at two or more places are opened: their windows are joined by content (64-bit hashes),
the first place of each content in corpus order (by id, then line) stays, and lines of
windows that repeat an earlier one go. Overlapping windows extend a match line by
line. A second pass extends it to its last line: lines at the end of a repeated run have too few words after them for a window of
their own, so the shortest runs that end in a line are joined in the same way, as far as they begin like a repeated window. The work
is linear in lines; no pairs of places are made. In a text that repeats itself the first window stays as a place, but
its lines go where a later, overlapping window that repeats it covers them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearspan.llm.common import need, written
from clearspan.llm.jaccard import bit_map, in_map
from clearspan.llm.spans import blocks, hash_spans, mix, words_of

MIN_WORDS = 50

_ROW = "key bigint, doc_id bigint, first int, last int, fingerprint bigint, at int, content bigint"
_TAIL = "key bigint, doc_id bigint, first int, last int, content bigint"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(1, n), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def lines_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all lines with a word: text, number in the text (from 0, blank lines count), hash of the words, number of words."""
    starts, ends, before = words_of(data, offsets)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none
    hashes = hash_spans(data, starts, ends)
    breaks = np.flatnonzero(data == 10)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(before))
    number = np.searchsorted(breaks, starts) - np.searchsorted(breaks, offsets[:-1])[text]
    new = np.ones(len(starts), bool)
    new[1:] = (text[1:] != text[:-1]) | (number[1:] != number[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(starts)))
    within = np.arange(len(starts)) - np.repeat(first, counts)
    powers = _powers(_ODD, int(counts.max()))
    lines = mix(np.add.reduceat(mix(hashes) * powers[within], first) ^ counts.astype(np.uint64))
    return text[first], number[first], lines, counts


def windows_of(text: np.ndarray, lines: np.ndarray, counts: np.ndarray, min_words: int) -> tuple[np.ndarray, ...]:
    """First and last line (as indices), fingerprint, its line, and content hash of every window."""
    n = len(lines)
    done = np.cumsum(counts)
    last = np.searchsorted(done, done - counts + min_words)  # first line where the words suffice
    text_end = np.searchsorted(text, text, "right")
    first = np.flatnonzero(last < text_end)
    last = last[first]
    if not len(first):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none, none.astype(np.uint64)
    edges = np.stack([first, last + 1], axis=1).ravel()
    padded = np.append(lines, np.uint64(0xFFFFFFFFFFFFFFFF))
    least = np.minimum.reduceat(padded, edges)[::2]
    # the place of the least hash: the first line from `first` on that has it
    order = np.lexsort((np.arange(n), lines))
    ranked = lines[order]
    low = np.searchsorted(ranked, least)
    same = np.full(len(first), -1, np.int64)
    pending = np.arange(len(first))
    while len(pending):
        cand = order[low[pending]]
        ok = cand >= first[pending]
        same[pending[ok]] = cand[ok]
        pending = pending[~ok]
        low[pending] += 1
    return first, last, least, same, contents_of(lines, first, last)


def contents_of(lines: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Content hash of every run of lines, given by first and last line."""
    up, down = _powers(_ODD, len(lines)), _powers(_INVERSE, len(lines))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(lines * up)])
    return mix((total[last + 1] - total[first]) * down[first] ^ (last - first + 1).astype(np.uint64))


def tails_of(text: np.ndarray, counts: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last line (as indices) of the shortest run that ends at each line, and the last line of the window at its first.

    Runs that are windows themselves are left out.
    """
    done = np.cumsum(counts)
    before = done - counts
    first = np.searchsorted(before, done - min_words, "right") - 1  # last line from which the words suffice
    last = np.flatnonzero(first >= np.searchsorted(text, text, "left"))
    first = first[last]
    window = np.searchsorted(done, before[first] + min_words)
    longer = window < last
    return first[longer], last[longer], window[longer]


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(key, runs) of the documents that lose lines; ``docs`` has (key, doc_id, text).

    ``runs`` are first and last line numbers of windows and tails that also occur earlier in the corpus, in
    order of id (null last), key and line. ``key`` stands for id and text: rows that agree in both
    are one place, and none of them repeats the other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches):
            text, number, lines, counts = lines_of(data, offsets)
            first, last, least, same, content = windows_of(text, lines, counts, min_words)
            owner = pa.array(text[first], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(owner),
                    batch.column(1).take(owner),
                    pa.array(number[first], pa.int32()),
                    pa.array(number[last], pa.int32()),
                    pa.array(least.view(np.int64), pa.int64()),
                    pa.array(number[same], pa.int32()),
                    pa.array(content.view(np.int64), pa.int64()),
                ],
                ["key", "doc_id", "first", "last", "fingerprint", "at", "content"],
            )

    windows = written(docs.select("key", "doc_id", "text").mapInArrow(run, _ROW), "line-windows")
    place = F.struct("key", "at")
    found = windows.groupBy("fingerprint").agg(F.min(place).alias("a"), F.max(place).alias("b")).filter("a <> b").select("fingerprint")
    opened = windows.join(found, "fingerprint", "left_semi")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key", "first")

    def repeated(rows: DataFrame) -> DataFrame:
        firsts = rows.groupBy("content").agg(F.min(order).alias("origin"), F.max(order).alias("latest")).filter("origin <> latest")
        return firsts.select("content", "origin")

    def later(rows: DataFrame, firsts: DataFrame) -> DataFrame:
        placed = rows.withColumn("place", order).join(firsts, "content").filter(F.col("place") > F.col("origin"))
        return placed.select("key", "first", "last")

    firsts = written(repeated(opened), "repeated-windows")
    words, bits = bit_map(firsts.select(F.col("content").alias("token")))
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run_tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches):
            text, number, lines, counts = lines_of(data, offsets)
            first, last, window = tails_of(text, counts, min_words)
            hit = in_map(contents_of(lines, first, window).view(np.int64), shared.value, bits)
            first, last = first[hit], last[hit]
            owner = pa.array(text[first], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(owner),
                    batch.column(1).take(owner),
                    pa.array(number[first], pa.int32()),
                    pa.array(number[last], pa.int32()),
                    pa.array(contents_of(lines, first, last).view(np.int64), pa.int64()),
                ],
                ["key", "doc_id", "first", "last", "content"],
            )

    tails = written(docs.select("key", "doc_id", "text").mapInArrow(run_tails, _TAIL), "line-tails")
    found = later(opened, firsts).union(later(tails, repeated(tails)))
    return found.groupBy("key").agg(F.collect_set(F.struct("first", "last")).alias("runs"))


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text") -> DataFrame:
    """``docs`` with the lines of later repeated runs cut out of ``text``, and with ``n_lines`` and ``n_removed``.

    ``n_lines`` counts lines with a word, ``n_removed`` those that went (blank lines inside a run go
    with it). Null and empty texts stay as they are and have 0 lines. Columns of ``docs`` with the
    names of the new ones are replaced; all rows stay.
    """
    need(docs, "doc_id", text)
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    doc_id = F.col("doc_id").cast("bigint")
    key = F.xxhash64(doc_id.isNull(), doc_id, F.xxhash64(text))
    rows = docs.select(F.struct(*own).alias("_row"), key.alias("key"), doc_id.alias("doc_id"), F.col(text).cast("string").alias("text"))
    runs = repeated_runs(rows.select("key", "doc_id", "text"), min_words)
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda x, i: ~F.exists("runs", lambda r: (r["first"] <= i) & (i <= r["last"])))
    joined = rows.join(runs, "key", "left").withColumn("_kept", F.when(F.col("runs").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")))

    def n_full(value):
        return F.coalesce(F.size(F.filter(F.split(value, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))), F.lit(0))

    n_lines, n_kept = n_full(F.col("text")), n_full(F.col("_kept"))
    n_removed = F.when(F.col("runs").isNull(), 0).when(F.col("text").isNull(), 0).otherwise(n_lines - F.when(F.size(kept) > 0, n_kept).otherwise(0))
    columns = [F.col("_kept").alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in own]
    return joined.select(
        *columns, F.when(F.col("text").isNull(), 0).otherwise(n_lines).cast("bigint").alias("n_lines"), n_removed.cast("bigint").alias("n_removed")
    )


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document of ``documents`` without the lines of runs of 50 words or more that occur earlier."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return without_repeats(docs)


#: DuckDB SQL of ``op1_line_dedup`` (ids are unique in the tables). A repeated run is the union of the shortest runs of 50 words
#: that begin at its lines and the shortest that end there, as far as they lie inside it.
OP1_SQL = r"""
WITH l AS (
  SELECT doc_id, i - 1 AS i, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
        FROM documents WHERE text IS NOT NULL)
), f AS (
  SELECT doc_id, i, array_to_string(w, ' ') AS words, row_number() OVER o AS k,
    sum(len(w)) OVER o AS upto, len(w) AS n
  FROM l WHERE len(w) > 0 WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), e AS (
  SELECT a.doc_id, a.k, min(b.k) AS last_k
  FROM f a JOIN f b ON a.doc_id = b.doc_id AND b.k >= a.k AND b.upto - a.upto + a.n >= 50 GROUP BY a.doc_id, a.k
  UNION
  SELECT b.doc_id, max(a.k) AS k, b.k AS last_k
  FROM f a JOIN f b ON a.doc_id = b.doc_id AND b.k >= a.k AND b.upto - a.upto + a.n >= 50 GROUP BY b.doc_id, b.k
), c AS (
  SELECT e.doc_id, min(f.i) AS first, max(f.i) AS last, list(f.words ORDER BY f.k) AS content
  FROM e JOIN f ON e.doc_id = f.doc_id AND f.k BETWEEN e.k AND e.last_k GROUP BY e.doc_id, e.k, e.last_k
), r AS (
  SELECT doc_id, first, last FROM (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, first) AS n FROM c) WHERE n > 1
), g AS (
  SELECT DISTINCT l.doc_id, l.i FROM l JOIN r ON l.doc_id = r.doc_id AND l.i BETWEEN r.first AND r.last
), t AS (
  SELECT l.doc_id, coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '') AS text,
    count(*) FILTER (WHERE len(l.w) > 0) AS n_lines, count(*) FILTER (WHERE len(l.w) > 0 AND g.i IS NOT NULL) AS n_removed
  FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id
)
SELECT d.doc_id, t.text, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed
FROM documents d LEFT JOIN t USING (doc_id)
"""
