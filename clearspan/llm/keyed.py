"""Token-id files with keyed access through minimal perfect hashing (operator 9).

A file set is a Parquet table with a row for each shard, in ascending order of document
keys. A shard holds its ids as one raw little-endian payload of unsigned 32-bit integers,
the offsets of its documents, and an index from keys to documents: a minimal perfect hash
function (a few levels of bits; a key's slot is the rank of its bit) and, for each slot, a
fingerprint that turns away foreign keys, the first document of the key and their number.
A lookup costs a few bit tests, whatever the size of the shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clearspan.llm.common import need, shared_path
from clearspan.llm.spans import blocks, mix
from clearspan.llm.tokens import crc_of, pieces, tokenizer_file

END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
#: A shard ends with the document that brings it to so many ids.
SHARD_IDS = 1 << 18
#: Bits for each key that is left at a level.
_SPREAD = 2.0

SHARD = (
    "part int, seq int, n_docs int, n_ids bigint, n_null int, min_key bigint, max_key bigint, doc_ids array<bigint>, "
    "offsets binary, ids binary, levels array<int>, bits binary, fingerprints binary, firsts binary, runs binary"
)


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys ^ mix(np.full(1, level + 1, np.uint64))) % np.uint64(size)).astype(np.int64)


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ np.uint64(0xD1B54A32D192ED03)) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Minimal perfect hash function of distinct 64-bit keys.

    At each level every key left falls on a bit of an array of twice as many bits; keys that fall
    alone are settled there, the others go on. A key's slot is the number of settled bits before its own.
    """

    def __init__(self, levels: list[int], bits: np.ndarray):
        self.levels, self.bits = levels, bits
        self.rank = np.concatenate([[0], np.cumsum(bits)]).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels: list[int] = []
        arrays: list[np.ndarray] = []
        left = keys
        while len(left):
            size = max(8, int(len(left) * _SPREAD))
            at = _place(left, len(levels), size)
            hits = np.bincount(at, minlength=size)
            levels.append(size)
            arrays.append(hits == 1)
            left = left[hits[at] > 1]
        return cls(levels, np.concatenate(arrays) if arrays else np.zeros(0, bool))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 or any slot for a key that was not built in."""
        out = np.full(len(keys), -1, np.int64)
        left, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.levels):
            at = base + _place(keys[left], level, size)
            settled = self.bits[at]
            out[left[settled]] = self.rank[at[settled]]
            left = left[~settled]
            base += size
        return out


class Shard:
    """A shard of the file set, as written or as read back."""

    def __init__(self, row: dict):
        self.doc_ids = row["doc_ids"]
        self.n_null = row["n_null"]
        self.offsets = np.frombuffer(row["offsets"], "<i8")
        self.ids = np.frombuffer(row["ids"], "<u4")
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(row["levels"])).astype(bool)
        self.hash = PerfectHash(list(row["levels"]), bits)
        self.fingerprints = np.frombuffer(row["fingerprints"], "<u4")
        self.firsts, self.runs = np.frombuffer(row["firsts"], "<i4"), np.frombuffer(row["runs"], "<i4")

    @staticmethod
    def make(part: int, seq: int, doc_ids: list, lengths: list[int], ids: list[np.ndarray]) -> dict:
        """The row of a shard. Documents come by ascending key, null keys first."""
        n_null = sum(d is None for d in doc_ids)
        own = np.array(doc_ids[n_null:], np.int64)
        keys, firsts, runs = np.unique(own, return_index=True, return_counts=True)
        hashed = keys.view(np.uint64)
        function = PerfectHash.build(hashed)
        order = np.argsort(function.slots(hashed))
        return {
            "part": part,
            "seq": seq,
            "n_docs": len(doc_ids),
            "n_ids": sum(lengths),
            "n_null": n_null,
            "min_key": int(keys[0]) if len(keys) else None,
            "max_key": int(keys[-1]) if len(keys) else None,
            "doc_ids": doc_ids,
            "offsets": np.concatenate([[0], np.cumsum(lengths)]).astype("<i8").tobytes(),
            "ids": np.concatenate(ids).astype("<u4").tobytes(),
            "levels": function.levels,
            "bits": np.packbits(function.bits).tobytes(),
            "fingerprints": _fingerprint(hashed)[order].astype("<u4").tobytes(),
            "firsts": (firsts[order] + n_null).astype("<i4").tobytes(),
            "runs": runs[order].astype("<i4").tobytes(),
        }

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First document and number of documents of each key (int64); -1 and 0 for foreign keys.

        A foreign key passes its fingerprint by chance once in 2**32.
        """
        hashed = np.ascontiguousarray(keys, np.int64).view(np.uint64)
        slots = self.hash.slots(hashed)
        known = slots >= 0
        known[known] = self.fingerprints[slots[known]] == _fingerprint(hashed[known])
        firsts, runs = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        firsts[known], runs[known] = self.firsts[slots[known]], self.runs[slots[known]]
        return firsts, runs

    def payload(self, doc: int) -> np.ndarray:
        """Ids of a document of the shard."""
        return self.ids[self.offsets[doc] : self.offsets[doc + 1]]


_SHARD_ARROW = pa.schema(
    [
        ("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int32()), ("n_ids", pa.int64()), ("n_null", pa.int32()),
        ("min_key", pa.int64()), ("max_key", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.binary()),
        ("ids", pa.binary()), ("levels", pa.list_(pa.int32())), ("bits", pa.binary()), ("fingerprints", pa.binary()),
        ("firsts", pa.binary()), ("runs", pa.binary()),
    ]
)


def write_shards(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID, shard_ids: int = SHARD_IDS, text: str = "text") -> None:
    """Encode every whole text and write the file set to ``path`` in ascending order of doc_id.

    Null texts are empty: only the end id. Null ids come first and have no key. Rows with one id lie
    side by side, by the hash of their text, and share a key. An empty table writes no shard.
    """
    need(docs, "doc_id", text)
    file = tokenizer_file(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seq = pieces(file), TaskContext.get().partitionId(), 0
        doc_ids: list = []
        lengths: list[int] = []
        held: list[np.ndarray] = []
        total = 0
        for batch, data, offsets in blocks(batches):
            ids, before = encoder.encode(data, offsets)
            for k, doc_id in enumerate(batch.column(0).to_pylist()):
                own = np.append(ids[before[k] : before[k + 1]], np.uint32(end_id))
                doc_ids.append(doc_id)
                lengths.append(len(own))
                held.append(own)
                total += len(own)
                if total >= shard_ids:
                    yield pa.RecordBatch.from_pylist([Shard.make(part, seq, doc_ids, lengths, held)], _SHARD_ARROW)
                    doc_ids, lengths, held, total, seq = [], [], [], 0, seq + 1
        if doc_ids:
            yield pa.RecordBatch.from_pylist([Shard.make(part, seq, doc_ids, lengths, held)], _SHARD_ARROW)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    shards = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, SHARD)
    shards.write.option("compression", "zstd").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Every document of a file set, found by its key: doc_id, start, n_tokens, ids_crc32, and its shard.

    Reads the payloads once and shuffles only these small rows. ``start`` counts the ids of all
    documents before it: totals are summed over range partitions, then over the shards of each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                shard = Shard(row)
                keys = np.unique(np.array(shard.doc_ids[shard.n_null :], np.int64))
                firsts, runs = shard.find(keys)
                found = np.concatenate(
                    [np.arange(shard.n_null), np.repeat(firsts, runs) + np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)]
                ).astype(np.int64)
                crcs = [crc_of(shard.payload(d)) for d in found.tolist()]
                names = [None] * shard.n_null + np.repeat(keys, runs).tolist()
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * n, pa.int32()),
                        pa.array([row["seq"]] * n, pa.int32()),
                        pa.array(names, pa.int64()),
                        pa.array(shard.offsets[found], pa.int64()),
                        pa.array(shard.offsets[found + 1] - shard.offsets[found], pa.int64()),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["part", "seq", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    files = spark.read.parquet(path)
    found = files.mapInArrow(run, "part int, seq int, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint")
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    parts = parts.select("part", (F.sum("n_ids").over(Window.orderBy("part")) - F.col("n_ids")).alias("ahead"))
    inner = Window.partitionBy("part").orderBy("seq")
    starts = files.select("part", "seq", (F.sum("n_ids").over(inner) - F.col("n_ids")).alias("before")).join(parts, "part")
    starts = starts.select("part", "seq", (F.col("ahead") + F.col("before")).alias("base"))
    return found.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "part", "seq"
    )


def fetch(spark: SparkSession, path: str, keys: list[int]) -> DataFrame:
    """Ids of the documents of a few keys: doc_id, ids. Keys without a document give no row.

    Shards are chosen by their key ranges in the Parquet statistics; inside, access is by hash.
    """
    wanted = sorted({int(k) for k in keys})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                shard = Shard(row)
                own = np.array([x for x in wanted if row["min_key"] is not None and row["min_key"] <= x <= row["max_key"]], np.int64)
                firsts, runs = shard.find(own)
                names = np.repeat(own, runs).tolist()
                docs = [f + j for f, r in zip(firsts.tolist(), runs.tolist(), strict=True) for j in range(r)]
                ids = [shard.payload(d).astype(np.int64) for d in docs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "ids"]
                )

    files = spark.read.parquet(path)
    if not wanted:
        return files.limit(0).mapInArrow(run, "doc_id bigint, ids array<bigint>")
    near = files.filter((F.col("min_key") <= wanted[-1]) & (F.col("max_key") >= wanted[0]))
    return near.mapInArrow(run, "doc_id bigint, ids array<bigint>")


def op9_keyed_token_files(spark, sf_dir: str) -> DataFrame:
    """``documents`` written to a new file set in the shared folder, and read back by key."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path = shared_path(spark, "token-files")
    write_shards(docs, path)
    return read_shards(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
