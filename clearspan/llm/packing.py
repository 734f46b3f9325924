"""Packing documents into training sequences by the sum-of-squares rule (operator 8).

A document is a run of token ids with an end id. Pieces no longer than a sequence are
placed one after the other: of all gaps that hold the piece, the one is taken after which
the sum over gaps of the squared number of open sequences with that gap is smallest; a new
sequence is opened only if no gap holds it. Pieces go by falling length. That keeps a supply
of different gaps for the short pieces, so that few sequences end unfilled.

Pieces of a full sequence's length are sequences of their own. The others are dealt at
random to groups of a bounded number of pieces, each packed by one task call; what a group
wastes on its last open sequences is a small, fixed part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearspan.llm.common import need, written
from clearspan.llm.spans import blocks
from clearspan.llm.tokens import crc_of, pieces, tokenizer_file

SEQUENCE = 2048
#: Pieces packed together on average.
GROUP = 8192
END_ID = 0
TOKENIZER = "word_bpe_49k.json"

_PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, salt bigint"


def token_pieces(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID, size: int = SEQUENCE, text: str = "text") -> DataFrame:
    """Each document as ids of ``tokenizer`` and ``end_id``, cut into pieces of ``size``; the last may be shorter.

    Columns: doc_id, piece (from 0), start (ids of the document before it), length, ids_crc32, and a
    pseudo-random ``salt`` from the content. A null or empty text is one piece: the end id. Repeated
    rows are documents of their own. The ids themselves stay in the task.
    """
    need(docs, "doc_id", text)

    path = tokenizer_file(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = pieces(path)
        for batch, data, offsets in blocks(batches):
            ids, before = encoder.encode(data, offsets)
            doc_ids = batch.column(0).to_pylist()
            rows: list[tuple] = []
            for k, doc_id in enumerate(doc_ids):
                own = np.append(ids[before[k] : before[k + 1]], np.uint32(end_id))
                for piece, start in enumerate(range(0, len(own), size)):
                    part = own[start : start + size]
                    crc = crc_of(part)
                    rows.append((doc_id, piece, start, len(part), crc, hash((doc_id, piece, crc, 8)) & 0x7FFFFFFF))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32", "salt"]
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, _PIECE)


def sum_of_squares(lengths: np.ndarray, size: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, placed in the given order.

    With N(g) open sequences of gap g, placing a piece of length s into a gap g > s changes the sum
    of squares by 2 (N(g - s) - N(g)) + 2, and filling a gap g = s by 1 - 2 N(s). The smallest change
    wins, ties go to the smallest gap. A sequence is opened only if no gap holds the piece. Lengths
    are from 1 to ``size``.
    """
    n_open = np.zeros(size + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(size + 1)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0
    for i, s in enumerate(lengths.tolist()):
        fitting = np.flatnonzero(n_open[s:size])  # gap - s
        if len(fitting):
            change = 2 * (n_open[fitting] * (fitting > 0) - n_open[fitting + s]) + 1 + (fitting > 0)
            gap = s + int(fitting[change.argmin()])
            bin_ = stacks[gap].pop()
            n_open[gap] -= 1
        else:
            gap, bin_ = size, made
            made += 1
        sequence[i], offset[i] = bin_, size - gap
        if gap > s:
            n_open[gap - s] += 1
            stacks[gap - s].append(bin_)
    return sequence, offset


def packed(rows: DataFrame, size: int = SEQUENCE, group: int = GROUP) -> DataFrame:
    """``rows`` (with length from 1 to ``size`` and salt) with ``sequence_id`` and ``offset`` in it.

    Within a group, pieces go by falling length; equal lengths by salt, then by id, piece and content. Pieces are dealt to
    groups by salt and by their place in ``rows``, a stored table, so that equal rows, however many, fill many groups.
    """
    n = rows.count()
    groups = max(1, round(n / group))
    extra = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    out = T.StructType([*rows.schema.fields, *extra])

    def run(key: tuple, table: pa.Table) -> pa.Table:
        order = [("length", "descending"), *((c, "ascending") for c in ("salt", "doc_id", "piece", "ids_crc32"))]
        table = table.drop_columns("_group").sort_by(order)
        sequence, offset = sum_of_squares(table["length"].to_numpy(), size)
        ids = pa.array((key[0].as_py() << 32) + sequence, pa.int64())
        return table.append_column("sequence_id", ids).append_column("offset", pa.array(offset, pa.int64()))

    dealt = rows.withColumn("_group", F.pmod(F.xxhash64("salt", F.monotonically_increasing_id()), F.lit(groups).cast("bigint")))
    return dealt.groupBy("_group").applyInArrow(run, out)


def op8_pack_documents(spark, sf_dir: str) -> DataFrame:
    """Every piece of ``documents`` with its place in a sequence."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return packed(written(token_pieces(docs), "pack-pieces")).drop("salt")
