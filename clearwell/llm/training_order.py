"""Token ids in training order, as fixed-stride binary shards.

The documents of a task are strung together, each with an end token, and cut into sequences of ``length`` tokens. They are
encoded once, into a staged table of compressed sequences. Its counts number all sequences densely; a keyed Feistel
permutation of those numbers gives each sequence its slot in the training order. Every sequence is then sent to
the range of slots it belongs to, where shards are written sorted by slot. All records have the same stride, so a reader
can start at any slot: see :func:`locate`.

A record is the number of tokens, ``length`` token ids (the rest filled up) and a zero, all
little-endian integers of the same width.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearwell.llm.common import has
from clearwell.llm.tokenizing import encoder, vocabulary
from clearwell.session import discard, new_folder, small_batches, stage

ROUNDS = 6
#: Sequences that are packed together, and how hard; sequences that a task sends on together.
BLOCK, LEVEL, TOGETHER = 256, 3, 1 << 15
#: Texts, and blocks or packs of sequences, that a Python worker is sent at a time.
TEXTS, PACKS = 512, 32


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Slots of the numbers below ``n``: a keyed permutation of ``range(n)``.

    A Feistel network permutes the next even power of two; results that are not below ``n`` are put in again
    until they are (cycle walking, fewer than four steps on average).
    """
    half = np.uint64(max(1, ((max(n, 2) - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))
    out = np.asarray(index, dtype=np.uint64).copy()
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> half, out[walking] & mask
        for k in keys:
            left, right = right, left ^ (_mix(right + k) & mask)
        out[walking] = (left << half) | right
        walking = walking[out[walking] >= n]
    return out.astype(np.int64)


def locate(slot: int, length: int, width: int, per_shard: int) -> tuple[int, int]:
    """Shard and byte offset of a slot."""
    return slot // per_shard, slot % per_shard * width * (length + 2)


def read_shards(spark: SparkSession, path: str, length: int, width: int, first_shard: int = 0) -> DataFrame:
    """``shard, place, n_tokens, tokens`` of the shards from ``first_shard`` on, each file read in one go."""
    dtype, stride = np.dtype(f"<u{width}"), length + 2

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0), batch.column(1), strict=True):
                rows = np.frombuffer(content.as_py(), dtype=dtype).reshape(-1, stride)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard.as_py()] * len(rows), pa.int64()), pa.array(np.arange(len(rows))),
                        pa.array(rows[:, 0].astype(np.int64)),
                        pa.array([r[1 : 1 + r[0]].astype(np.int32) for r in rows], pa.list_(pa.int32())),
                    ],
                    names=["shard", "place", "n_tokens", "tokens"],
                )

    files = spark.read.format("binaryFile").load(path).where(F.col("shard") >= first_shard)
    return files.select(F.col("shard").cast("long").alias("shard"), "content").mapInArrow(
        records, "shard long, place long, n_tokens long, tokens array<int>"
    )


class _Stream:
    """The tokens of one task's documents, cut into sequences; what does not fill one waits for the next document."""

    def __init__(self, length: int, dtype: np.dtype, end: int):
        self.length, self.dtype, self.end = length, dtype, end
        self.waiting, self.pieces = np.zeros(0, dtype), []

    def add(self, documents: list[tuple]) -> list[tuple[np.ndarray, list[dict]]]:
        """Full sequences with their pieces of ``(key, tokens)`` documents; one without tokens leaves no trace."""
        parts, at, end = [self.waiting], len(self.waiting), np.array([self.end], self.dtype)
        pieces = [(0, piece) for piece in self.pieces]
        for key, ids in documents:
            if not len(ids):
                continue
            done = 0
            while done < len(ids):
                sequence, place = divmod(at + done, self.length)
                n = min(self.length - place, len(ids) - done)
                number = 0 if not done else pieces[-1][1]["seq_no"] + 1
                pieces.append((sequence, {"key": key, "seq_no": number, "at": place, "n": n}))
                done += n
            parts += [np.asarray(ids, self.dtype), end]
            at += len(ids) + 1
        tokens = np.concatenate(parts)
        full = len(tokens) // self.length
        out = [(tokens[i * self.length : (i + 1) * self.length], []) for i in range(full)]
        self.waiting, self.pieces = tokens[full * self.length :].copy(), []
        for sequence, piece in pieces:
            (out[sequence][1] if sequence < full else self.pieces).append(piece)
        return out

    def rest(self) -> list[tuple[np.ndarray, list[dict]]]:
        return [(self.waiting, self.pieces)] if len(self.waiting) else []


def _encode(documents: DataFrame, file: str, length: int, width: int, end: int) -> DataFrame:
    """``slice, place, n, block, pieces``: blocks of ``n`` sequences, packed together, with the pieces of documents in
    them. ``place`` is that of the first one and counts the sequences of a task; pieces have their own."""
    kind = documents.schema["key"].dataType.simpleString()
    pieces = f"array<struct<key:{kind},seq_no:bigint,place:bigint,at:int,n:int>>"
    dtype = np.dtype(f"<u{width}")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, slice_, place = encoder(file), TaskContext.get().partitionId(), 0
        pack, stream, key_type, waiting = zstandard.ZstdCompressor(LEVEL).compress, _Stream(length, dtype, end), None, []

        def block(found: list) -> pa.RecordBatch:
            nonlocal place
            of = [piece | {"place": place + i} for i, (_, pieces) in enumerate(found) for piece in pieces]
            piece = pa.struct([
                ("key", key_type), ("seq_no", pa.int64()), ("place", pa.int64()), ("at", pa.int32()), ("n", pa.int32()),
            ])
            tokens = np.concatenate([ids for ids, _ in found]).tobytes()
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([slice_], pa.int32()), pa.array([place], pa.int64()), pa.array([len(found)], pa.int64()),
                    pa.array([pack(tokens)], pa.binary()), pa.array([of], pa.list_(piece)),
                ],
                names=["slice", "place", "n", "block", "pieces"],
            )
            place += len(found)
            return out

        for batch in batches:
            key_type = batch.column(0).type
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                keys, texts = part.column(0).to_pylist(), part.column(1)
                waiting += stream.add([(k, encode(t.as_py() or "")) for k, t in zip(keys, texts, strict=True)])
                while len(waiting) >= BLOCK:
                    yield block(waiting[:BLOCK])
                    del waiting[:BLOCK]
        if last := waiting + stream.rest():
            yield block(last)

    return documents.mapInArrow(encoded, f"slice int, place bigint, n bigint, block binary, pieces {pieces}")


def training_order(documents: DataFrame, path: str | None = None, seed: int = 42, key: str = "doc_id",
                   text: str = "text", file: str = "byte_bpe_50k.json", length: int = 512,
                   per_shard: int = 8192) -> DataFrame:
    """Write the shards and return ``key, seq_no, n_tokens, slot, shard, byte_offset, path`` of every piece.

    A document is in one sequence or, in pieces numbered from 0, in several that follow each other; a piece has ``n_tokens``
    and begins at ``byte_offset`` of the shard file below ``path``. Shard ``s`` is the file in ``path/shard=s`` and
    holds the slots from ``s * per_shard`` on; without a ``path`` a new folder in the shared one is taken. Only the last
    sequence of a task is not full. Tokens are encoded once; the staged table of sequences is removed when the shards
    are written.

    NULL and empty texts have no tokens and no piece. Keys keep their type; a NULL key is kept as NULL. Repeated rows
    have pieces of their own. An empty table gives no shards and an empty result. Other columns are not read.
    """
    has(documents, key=key, text=text)
    path = path or new_folder(documents.sparkSession, "training-order")
    ids, end = vocabulary(file)
    width = 2 if ids <= 1 << 16 else 4
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    with small_batches(rows.sparkSession, TEXTS):
        sequences = stage(_encode(rows, file, length, width, end), "training-sequences")
    offsets, total = {}, 0
    for row in sorted(sequences.groupBy("slice").agg(F.sum("n").alias("n")).collect()):  # one row per task
        offsets[row["slice"]] = total
        total += row["n"]
    if total:
        with small_batches(rows.sparkSession, PACKS):
            _write(sequences, path, offsets, length, width, end, per_shard, total, seed)
    pieces = sequences.select("slice", F.explode("pieces").alias("piece")).select("slice", "piece.*")
    stride = width * (length + 2)
    placed = _with_slots(pieces, offsets, total, seed).withColumn("shard", F.floor(F.col("slot") / per_shard))
    manifest = stage(
        placed.select(
            "key", "seq_no", F.col("n").cast("long").alias("n_tokens"), "slot", "shard",
            (F.col("slot") % per_shard * stride + width * (F.col("at") + 1)).alias("byte_offset"),
        ),
        "training-manifest",
    )
    discard(sequences)
    return manifest.withColumn("path", F.lit(path)).withColumnRenamed("key", key)


def _with_slots(pieces: DataFrame, offsets: dict[int, int], total: int, seed: int) -> DataFrame:
    """``pieces`` of ``(slice, place, ...)`` with their slot instead of the first two columns."""
    shared = pieces.sparkSession.sparkContext.broadcast(offsets)  # one number per slice
    others = [f for f in pieces.schema if f.name not in ("slice", "place")]

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = np.array([shared.value[s] for s in batch.column(0).to_pylist()], dtype=np.int64)
            slots = permute(first + batch.column(1).to_numpy(), total, seed)
            yield pa.RecordBatch.from_arrays([pa.array(slots), *batch.columns[2:]], names=["slot", *batch.schema.names[2:]])

    schema = ", ".join(["slot bigint", *(f"{f.name} {f.dataType.simpleString()}" for f in others)])
    return pieces.select("slice", "place", *[f.name for f in others]).mapInArrow(numbered, schema)


def _write(sequences: DataFrame, path: str, offsets: dict[int, int], length: int, width: int, fill: int, per_shard: int,
           total: int, seed: int) -> None:
    """Send every record to its range of shards, those of one task and range packed together, and write them sorted."""
    shards = -(-total // per_shard)
    ranges = min(shards, int(sequences.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shared = sequences.sparkSession.sparkContext.broadcast(offsets)  # one number per slice
    dtype = np.dtype(f"<u{width}")

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, unpack = zstandard.ZstdCompressor(LEVEL).compress, zstandard.ZstdDecompressor().decompress
        waiting: list[np.ndarray] = []
        places: list[np.ndarray] = []

        def packed() -> pa.RecordBatch:
            slots, records = permute(np.concatenate(places), total, seed), np.concatenate(waiting)
            range_ = slots // per_shard * ranges // shards
            order = np.lexsort((slots, range_))
            of, first = np.unique(range_[order], return_index=True)
            parts = np.split(order, first[1:])
            waiting.clear()
            places.clear()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(of, pa.int32()), pa.array([slots[p] for p in parts], pa.list_(pa.int64())),
                    pa.array([pack(records[p].tobytes()) for p in parts], pa.binary()),
                ],
                names=["range", "slots", "records"],
            )

        for batch in batches:
            for slice_, place, n, block in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                ids = np.frombuffer(unpack(block, max_output_size=n * length * width), dtype)
                records = np.full((n, length + 1), fill, dtype)
                records[:, 0] = length
                records[-1, 0] = len(ids) - (n - 1) * length
                full = len(ids) // length
                records[:full, 1:] = ids[: full * length].reshape(full, length)
                if full < n:
                    records[-1, 1 : 1 + len(ids) - full * length] = ids[full * length :]
                waiting.append(records)
                places.append(shared.value[slice_] + place + np.arange(n))
                if len(waiting) * BLOCK >= TOGETHER:
                    yield packed()
        if waiting:
            yield packed()

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, size = zstandard.ZstdDecompressor().decompress, width * (length + 1)
        for batch in batches:
            for slots, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                whole = unpack(records, max_output_size=size * len(slots))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([s // per_shard for s in slots], pa.int64()), pa.array(slots, pa.int64()),
                        pa.array([whole[i : i + size] for i in range(0, len(whole), size)], pa.binary()),
                    ],
                    names=["shard", "slot", "record"],
                )

    blocks = sequences.select("slice", "place", "n", "block")
    sent = blocks.mapInArrow(dealt, "range int, slots array<bigint>, records binary").repartitionById(ranges, "range")
    records = sent.select("slots", "records").mapInArrow(unpacked, "shard bigint, slot bigint, record binary")
    ordered = records.sortWithinPartitions("shard", "slot").select("shard", F.col("record").cast("string").alias("value"))
    # The text writer copies bytes as they are; the separator is the zero that ends a record.
    ordered.write.partitionBy("shard").option("lineSep", "\0" * width).text(path)
