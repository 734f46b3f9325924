"""Ranked lexical search by dense blocked matrix products (operator 12).

The terms of all items make a compact vocabulary. One pass over the documents leaves, for each
document, its number of terms and the vocabulary terms in it; counts over all documents
follow from that table. Scores are products of two dense tiles in float64: weights of a block of
items by vocabulary terms, times impacts of these terms in a block of documents. Weights and impacts
are whole numbers, and a tile has so few terms that no partial sum reaches 2^53, so every
product is exact; tiles of one item are added up as 64-bit integers. The best of a tile are those
that reach its k-th score, ties by document id, so no tile loses a row that the whole ranking needs; a task passes
over those below the k-th score of its tiles before, and lets equal ones through.

Items go to the tasks in parts of bounded size (``PART_ENTRIES`` pairs of item and term), one part after another, however
many items there are; a task makes one dense tile at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clearspan.llm.common import need, written
from clearspan.llm.spans import blocks, hash_spans, lowered, words_of

#: Pairs of item and term, and so also terms, of one part of the items; 24 bytes each are broadcast.
PART_ENTRIES = 1 << 20
#: Items of one part; a task holds the k best scores of each.
PART_ITEMS = 1 << 14
#: Items and documents of a tile; terms of a tile, if 2^53 allows as many.
ITEMS, DOCS, TERMS = 256, 512, 2048
#: A sum of products below this is exact in float64.
EXACT = 1 << 53
#: An impact is below this: (10^9 tf) div (1000 tf + 20 m), m > 0.
MOST_IMPACT = 1_000_000
#: Rows of one item are ranked in so many shares before the last ranking.
SHARES = 64

_APART = np.ones(256, bool)
_APART[48:58] = _APART[65:91] = _APART[97:123] = _APART[128:] = False

_KEY = "_row"


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every term of the texts in a row (A-Z in small letters), and for each text the number of terms before it."""
    small = lowered(data)
    starts, ends, before = words_of(small, offsets, _APART)
    return hash_spans(small, starts, ends).view(np.int64), before


def item_terms(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, term): each term of an item once, as a 64-bit hash. Rows that share an item id are one item."""
    need(items, item, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches):
            hashes, before = _terms(data, offsets)
            row = np.repeat(np.arange(batch.num_rows), np.diff(before))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(hashes)], names=["item", "term"])

    rows = items.select(F.col(item).alias("item"), F.col(text).alias("text"))
    kind = rows.schema["item"].dataType.simpleString()
    return rows.mapInArrow(run, f"item {kind}, term bigint").distinct()


def vocabulary_hits(docs: DataFrame, terms: np.ndarray, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, n, term, tf) of every document: number of its terms, and the vocabulary terms in it with their counts.

    ``terms`` are sorted hashes, of bounded number. Whole texts are read in one pass.
    """
    need(docs, doc, text)
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch, data, offsets in blocks(batches):
            hashes, before = _terms(data, offsets)
            at = np.minimum(np.searchsorted(known, hashes), max(0, len(known) - 1))
            hit = known[at] == hashes if len(known) else np.zeros(len(hashes), bool)
            row = np.repeat(np.arange(batch.num_rows, dtype=np.int64), np.diff(before))[hit]
            pairs, tf = np.unique(row * max(1, len(known)) + at[hit], return_counts=True)
            row, term = np.divmod(pairs, max(1, len(known)))
            edges = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32())
            columns = [batch.column(0), pa.array(np.diff(before), pa.int64())]
            columns += [pa.ListArray.from_arrays(edges, pa.array(x, kind)) for x, kind in ((term, pa.int32()), (tf, pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "n", "term", "tf"])

    rows = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc {kind}, n bigint, term array<int>, tf array<bigint>")


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, all_terms: int) -> np.ndarray:
    """Impact of a term in a document with ``n`` terms, by whole numbers."""
    m = 100 - 50 + (50 * n * n_docs) // all_terms
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    """Weight of a term that ``df`` documents hold."""
    return np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)


class Tiles:
    """The items of one part: rows of weights over a compact vocabulary, in blocks of items."""

    def __init__(self, items: np.ndarray, terms: np.ndarray, weight: np.ndarray):
        """Pairs of item number and vocabulary number, and the weight of every vocabulary number."""
        self.blocks = []
        # each product of a weight and an impact is below most, so this many of them stay below 2^53
        most = max(1, int(weight.max(initial=0))) * MOST_IMPACT
        self.width = max(1, min(TERMS, EXACT // most - 1))
        order = np.argsort(items, kind="stable")
        items, terms = items[order], terms[order]
        for a in range(0, int(items.max(initial=-1)) + 1, ITEMS):
            mine = slice(*np.searchsorted(items, [a, a + ITEMS]))
            words, column = np.unique(terms[mine], return_inverse=True)
            row = items[mine] - a
            tiles = []
            for b in range(0, len(words), self.width):
                here = (column >= b) & (column < b + self.width)
                tiles.append((words[b : b + self.width], row[here], column[here] - b))
            self.blocks.append((a, int(row.max(initial=-1)) + 1, tiles))
        self.weight = weight

    def scores(self, row: np.ndarray, term: np.ndarray, impact: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
        """First item of each block, and the scores of its items (down) in ``n`` documents (across)."""
        for first, n_items, tiles in self.blocks:
            total = None
            for words, item, column in tiles:
                at = np.minimum(np.searchsorted(words, term), len(words) - 1)
                hit = words[at] == term
                if not hit.any():
                    continue
                right = np.zeros((len(words), n))
                right[at[hit], row[hit]] = impact[hit]
                left = np.zeros((n_items, len(words)))
                left[item, column] = self.weight[words[column]]
                part = (left @ right).astype(np.int64)
                total = part if total is None else total + part
            if total is not None:
                yield first, total


def _best(scores: np.ndarray, order: np.ndarray, k: int, least: np.ndarray | int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's ``k`` highest scores from ``least`` (above 0) on, ties to the smaller ``order``."""
    n = scores.shape[1]
    least = np.broadcast_to(np.maximum(least, 1), len(scores))
    if n > k:
        least = np.maximum(least, np.partition(scores, n - k, axis=1)[:, n - k])
    row, column = np.nonzero(scores >= least[:, None])
    by = np.lexsort((order[column], -scores[row, column], row))
    row, column = row[by], column[by]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], column[place < k]


def _ranked(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Rows with their rank among those of the same keys, up to ``k``."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc"), _KEY)
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 50, doc: str = "doc_id", item: str = "item_id", text: str = "text", part: int = PART_ENTRIES) -> DataFrame:
    """(item, rank, doc, score): the ``k`` highest-scoring documents of each item, score above 0.

    Equal scores go to the smaller document id, null ids last; documents that share an id are ranked on
    their own. Null and empty texts have no terms: such items find nothing, such documents are neither found nor
    counted. No items or no documents give no rows. Terms are compared by 64-bit hashes. Other columns play no part.
    """
    spark = docs.sparkSession
    wanted = written(item_terms(items, item, text), "search-items")
    kind = wanted.schema["item"].dataType.simpleString()
    doc_kind = docs.schema[doc].dataType.simpleString()
    n_pairs, n_items = wanted.agg(F.count(F.lit(1)), F.approx_count_distinct(F.struct("item"))).first()
    parts = max(1, -(-n_pairs // part), -(-n_items // PART_ITEMS))
    found = None
    for p in range(parts):
        # whole items go to one part; an item alone has at most as many terms as its text
        mine = wanted.filter(F.pmod(F.xxhash64("item"), F.lit(parts)) == p).toArrow()
        if not mine.num_rows:
            continue
        ids = mine.column("item").combine_chunks().dictionary_encode(null_encoding="encode")
        vocabulary, column = np.unique(mine.column("term").to_numpy(), return_inverse=True)
        hits = written(vocabulary_hits(docs, vocabulary, doc, text), "search-hits")
        n_docs, all_terms = hits.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
        if not n_docs:
            continue
        counts = hits.select(F.explode("term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toArrow()
        df = np.zeros(len(vocabulary), np.int64)
        df[counts.column("term").to_numpy()] = counts.column("df").to_numpy()
        shared = spark.sparkContext.broadcast((ids.indices.to_numpy().astype(np.int64), column.astype(np.int64), weights(df, n_docs)))
        part_rows = _scored(hits, shared, ids.dictionary, n_docs, all_terms, k, kind, doc_kind)
        found = part_rows if found is None else found.unionByName(part_rows)
    if found is None:
        return spark.createDataFrame([], f"item {kind}, rank int, doc {doc_kind}, score bigint").withColumnsRenamed({"item": item, "doc": doc})
    shares = found.withColumn("share", F.pmod(F.xxhash64("doc", _KEY), F.lit(SHARES)))
    best = _ranked(_ranked(shares, ["item", "share"], k).drop("rank", "share"), ["item"], k)
    return best.select(F.col("item").alias(item), "rank", F.col("doc").alias(doc), "score")


def _scored(hits: DataFrame, shared, names: pa.Array, n_docs: int, all_terms: int, k: int, kind: str, doc_kind: str) -> DataFrame:
    """The best documents of each item of one part, at most ``k`` for each item and tile of documents."""
    size = DOCS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = Tiles(*shared.value)
        held = np.zeros((len(names), k), np.int64)  # the task's k highest scores of each item, ascending
        for batch in batches:
            # a document's place among equal ids: any order does, it only tells rows apart
            for a in range(0, batch.num_rows, size):
                tile = batch.slice(a, size)
                n_of = tile.column(1).to_numpy()
                lists = tile.column(2)
                row = np.repeat(np.arange(tile.num_rows), lists.value_lengths().to_numpy())
                term = lists.flatten().to_numpy().astype(np.int64)
                tf = tile.column(3).flatten().to_numpy()
                impact = impacts(tf, n_of[row], n_docs, all_terms)
                order = np.empty(tile.num_rows, np.int64)
                order[pc.array_sort_indices(tile.column(0), order="ascending").to_numpy()] = np.arange(tile.num_rows)
                for first, scores in tiles.scores(row, term, impact, tile.num_rows):
                    mine = held[first : first + len(scores)]
                    down, across = _best(scores, order, k, mine[:, 0])
                    if len(down):
                        place = np.arange(len(down)) - np.searchsorted(down, down)
                        found = np.zeros((len(scores), k), np.int64)
                        found[down, place] = scores[down, across]
                        mine[:] = np.sort(np.concatenate([mine, found], axis=1), axis=1)[:, k:]
                        yield pa.RecordBatch.from_arrays(
                            [names.take(pa.array(down + first)), tile.column(0).take(pa.array(across)), pa.array(scores[down, across]), tile.column(4).take(pa.array(across))],
                            names=["item", "doc", "score", _KEY],
                        )

    keyed = hits.withColumn(_KEY, F.monotonically_increasing_id())
    return keyed.mapInArrow(run, f"item {kind}, doc {doc_kind}, score bigint, {_KEY} bigint")


def op12_lexical_search(spark, sf_dir: str) -> DataFrame:
    """The 50 best of all ``documents`` for each ``benchmark`` item."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return search(docs, items)


#: DuckDB SQL of ``op12_lexical_search``.
OP12_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term
), len AS (
  SELECT doc_id, sum(tf) AS n FROM tf GROUP BY doc_id
), whole AS (
  SELECT count(*) AS n_docs, sum(n) AS all_terms FROM len
), wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), weight AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
  FROM tf, whole WHERE term IN (SELECT term FROM wanted) GROUP BY term
), scores AS (
  SELECT item_id, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * CAST(50 + (50 * n * n_docs) // all_terms AS BIGINT)))) AS BIGINT) AS score
  FROM wanted JOIN weight USING (term) JOIN tf USING (term) JOIN len USING (doc_id), whole
  GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
