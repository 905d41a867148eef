"""Operator 2: documents as token ids in training order, in binary shards of fixed stride.

A sequence holds up to ``LENGTH`` ids of one document, the last one closed by the end id and
filled with it; it is a record of ``2 * LENGTH`` bytes, little-endian. Sequences are landed once
and numbered in the order of the landed parts. A keyed Feistel permutation, walked until it
falls inside the number of sequences, gives each its slot; record ``slot % ROWS`` of shard
``slot // ROWS`` is its place, so a reader seeks to any slot and resumes there. The sequences
are landed again by slot, a file a shard, and the first table goes before the shards are written
from the second. A task gets whole shards, sorted, and writes each under a name of its own
before moving it into place: a repeated task writes the same bytes.

The vocabulary's path is a parameter; its file is read by the driver and broadcast (under
1 MB). Null and empty texts are a sequence of the end id alone. Repeated rows and ids are
sequences of their own, a null id stays null, empty tables give no shard. Other columns are
not read.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from staytally.llm import words as W
from staytally.llm.scratch import Scratch

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50256
LENGTH, ROWS = 256, 1 << 15
KEY = 0x5EED
_ROUNDS = 6
_CACHED = 1 << 20
_OTHER_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")


class Permutation:
    """A keyed bijection of range(n): Feistel rounds over the next even number of bits, again
    and again until the value is below n."""

    def __init__(self, n: int, key: int) -> None:
        self.n = n
        self.half = np.uint64(max(1, (max(1, n - 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        seeds = (np.arange(1, _ROUNDS + 1, dtype=np.uint64) + np.uint64(key)) * W.BASE
        self.keys = W.mix(seeds)

    def _once(self, x, keys, back: bool):
        left, right = x >> self.half, x & self.mask
        for key in keys:
            if back:
                left, right = right ^ (W.mix(left ^ key) & self.mask), left
            else:
                left, right = right, left ^ (W.mix(right ^ key) & self.mask)
        return (left << self.half) | right

    def _walk(self, x, keys, back) -> np.ndarray:
        x = np.asarray(x, np.uint64)
        out = self._once(x, keys, back)
        while len(outside := np.flatnonzero(out >= np.uint64(self.n))):
            out[outside] = self._once(out[outside], keys, back)
        return out.astype(np.int64)

    def slot(self, index) -> np.ndarray:
        return self._walk(index, self.keys, False)

    def index(self, slot) -> np.ndarray:
        return self._walk(slot, self.keys[::-1], True)


class Encoder(dict):
    """Ids as bytes. A space between two other characters always begins a piece of its own, so
    texts are cut there and what follows a space is encoded once and remembered."""

    def __init__(self, vocabulary: bytes) -> None:
        import tiktoken

        ranks = {
            base64.b64decode(token): int(rank)
            for token, rank in map(bytes.split, vocabulary.splitlines())
        }
        self.encoding = tiktoken.Encoding(
            "ids", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def _ids(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), "<u2").tobytes()

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= _CACHED:
            self.clear()
        ids = self[piece] = self._ids(" " + piece)
        return ids

    def encode(self, text: str) -> bytes:
        odd = (
            text[:1] == " "
            or text[-1:] == " "
            or "  " in text
            or " \n" in text
            or "\n " in text
            or _OTHER_SPACE.search(text)
        )
        first, *rest = _SAFE_SPACE.split(text) if odd else text.split(" ")
        return self._ids(first) + b"".join(map(self.__getitem__, rest))


def _sequences(vocabulary, length: int):
    end = np.array([END], "<u2").tobytes()
    stride = 2 * length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, row = Encoder(vocabulary.value), 0
        part = TaskContext.get().partitionId()
        for batch in W.slices(batches, "text"):
            of, number, sizes, records = [], [], [], []
            for d, text in enumerate(batch.column("text").to_pylist()):
                ids = encoder.encode(text or "") + end
                for k, at in enumerate(range(0, len(ids), stride)):
                    record = ids[at : at + stride]
                    of.append(d)
                    number.append(k)
                    sizes.append(len(record) // 2)
                    records.append(record + end * (length - len(record) // 2))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(of, pa.int64())),
                    pa.array(number, pa.int64()),
                    pa.array(sizes, pa.int32()),
                    pa.array(records, pa.binary()),
                    pa.array(np.full(len(of), part, np.int64)),
                    pa.array(np.arange(row, row + len(of))),
                ],
                names=["doc_id", "seq_no", "n_tokens", "record", "part", "row"],
            )
            row += len(of)

    return run


def _slots(held, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, offsets, permutation = held.value
        for batch in batches:
            at = np.searchsorted(parts, batch.column("part").to_numpy())
            slot = permutation.slot(offsets[at] + batch.column("row").to_numpy())
            kept = batch.select(["doc_id", "seq_no", "n_tokens", "record"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(slot), pa.array((slot // rows).astype(np.int32))],
                names=[*kept.schema.names, "slot", "shard"],
            )

    return run


def _store(folder: str):
    return pafs.FileSystem.from_uri(folder if "://" in folder else re.sub("^file:", "", folder))


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def _written(folder: str, rows: int, length: int):
    """Rows come sorted by slot; a shard's rows are consecutive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        open_shard, sink, own = None, None, ""

        def close() -> None:
            if sink is not None:
                sink.close()
                store.move(own, f"{root}/{shard_name(open_shard)}")

        for batch in batches:
            records = batch.column("record").to_pylist()
            for shard, record in zip(batch.column("shard").to_pylist(), records, strict=True):
                if shard != open_shard:
                    close()
                    open_shard, own = shard, f"{root}/_{shard_name(shard)}.{attempt}"
                    sink = store.open_output_stream(own)
                sink.write(record)
            slot = batch.column("slot").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.select(["doc_id", "seq_no", "n_tokens", "slot", "shard"]).columns,
                    pa.array((slot % rows) * (2 * length)),
                    pa.array([zlib.crc32(r) for r in records], pa.int64()),
                ],
                names=["doc_id", "seq_no", "n_tokens", "slot", "shard", "byte_offset", "crc32"],
            )
        close()

    return run


def write_token_shards(
    docs: DataFrame,
    folder: str | None = None,
    *,
    id: str = "doc_id",
    text: str = "text",
    vocabulary: str = VOCABULARY,
    length: int = LENGTH,
    rows: int = ROWS,
    key: int = KEY,
) -> DataFrame:
    """The manifest: one row a sequence with its slot, shard, byte offset and record checksum.

    The shards are written to ``folder``, or if none is given to one of its own in the shared one.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "tokens")
    folder = folder or f"{scratch.path}/shards"
    with open(vocabulary, "rb") as file:
        held = spark.sparkContext.broadcast(file.read())
    docs = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema["doc_id"].dataType
    fields = [StructField("doc_id", kind)]
    schema = StructType.fromDDL("seq_no bigint, n_tokens int, record binary")
    fields += schema.fields
    landed = scratch.land(
        docs.mapInArrow(
            _sequences(held, length),
            StructType([*fields, *StructType.fromDDL("part bigint, row bigint").fields]),
        ),
        "sequences",
        compression="zstd",
    )
    counts = landed.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()
    n = np.array([r.n for r in counts], np.int64)
    total = int(n.sum())
    numbering = (
        np.array([r.part for r in counts], np.int64),
        np.cumsum(n) - n,
        Permutation(max(1, total), key),
    )
    numbering = spark.sparkContext.broadcast(numbering)
    placed = landed.mapInArrow(
        _slots(numbering, rows),
        StructType([*fields, *StructType.fromDDL("slot bigint, shard int").fields]),
    )
    shards = max(1, -(-total // rows))
    out = StructType.fromDDL(
        "seq_no bigint, n_tokens int, slot bigint, shard int, byte_offset bigint, crc32 bigint"
    )
    ordered = placed.repartitionById(shards, F.col("shard")).sortWithinPartitions("slot")
    # A file of one row group is never divided among tasks.
    whole = {"parquet.block.size": max(1 << 27, 4 * length * rows), "maxRecordsPerFile": 0}
    ordered = scratch.land(ordered, "ordered", compression="zstd", **whole)
    scratch.drop(landed)
    manifest = ordered.mapInArrow(
        _written(folder, rows, length), StructType([fields[0], *out.fields])
    )
    manifest = scratch.land(manifest, "manifest")
    scratch.drop(ordered)
    return manifest


def read_slots(folder: str, first: int, last: int, *, length: int = LENGTH, rows: int = ROWS):
    """Records of the slots [first, last) in training order: sequential reads, from any slot."""
    store, root = _store(folder)
    stride, slot = 2 * length, first
    while slot < last:
        shard = slot // rows
        stop = min(last, (shard + 1) * rows)
        with store.open_input_file(f"{root}/{shard_name(shard)}") as file:
            file.seek((slot % rows) * stride)
            raw = file.read((stop - slot) * stride)
        yield np.frombuffer(raw, "<u2").reshape(-1, length)
        slot = stop
