"""Token-id files in patched frame-of-reference blocks.

A shard file holds the ids of consecutive documents as one stream, cut into blocks of
``BLOCK`` ids.  A block stores its minimum, a bit width chosen so that ``PERCENTILE`` of its
offsets from the minimum fit, the low bits of all offsets packed at that width, and an
exception list (position, high bits) for the rest.  The footer indexes the byte where each
block starts and lists the documents with their id counts, so any id range can be read alone.

File: MAGIC | blocks | footer (zlib) | footer length u64 | MAGIC
Block: minimum u32, width u8, exceptions u8, 16 * width packed bytes, positions u8[], highs u32[]
Footer: ids u64, blocks u64, documents u64, block starts u64[], doc ids i64[], doc-id nulls u8[], counts u64[]
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kindred.llm.common import map_arrow, new_dir, shuffle_partitions, stage
from kindred.llm.tokens import batches_of, byte_encoder

MAGIC = b"KTOKPF1\n"
BLOCK = 128
PERCENTILE = 0.9
#: Ids that the writer buffers and the reader decodes at a time.
RUN = 512 * BLOCK

MANIFEST = "shard int, file string, n_docs long, n_tokens long, n_blocks long, n_bytes long"


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """Each block of ``ids`` (unsigned 32-bit; the last block may be short) as bytes."""
    if not len(ids):
        return []
    full = -(-len(ids) // BLOCK) * BLOCK
    padded = np.full(full, ids[-1], dtype=np.uint32)
    padded[: len(ids)] = ids
    grid = padded.reshape(-1, BLOCK)
    low = grid.min(axis=1)
    off = grid - low[:, None]
    at = min(BLOCK - 1, int(np.ceil(PERCENTILE * BLOCK)) - 1)
    width = np.frexp(np.partition(off, at, axis=1)[:, at].astype(np.float64))[1].astype(np.uint8)
    high = (off.astype(np.uint64) >> width[:, None].astype(np.uint64)).astype(np.uint32)
    packed: list[bytes] = [b""] * len(grid)
    for w in np.unique(width).tolist():
        if w:
            rows = np.flatnonzero(width == w)
            size = 2 if w <= 16 else 4
            plain = off[rows].astype(f"<u{size}").view(np.uint8).reshape(len(rows), BLOCK, size)
            bits = np.unpackbits(plain, axis=2, bitorder="little")
            raw = np.packbits(bits[:, :, :w].reshape(len(rows), BLOCK * w), axis=1, bitorder="little").tobytes()
            size = BLOCK * w // 8
            for k, r in enumerate(rows.tolist()):
                packed[r] = raw[k * size : (k + 1) * size]
    row, pos = np.nonzero(high)
    ends = np.cumsum(np.bincount(row, minlength=len(grid))).tolist()
    pos_raw, high_raw = pos.astype(np.uint8).tobytes(), high[row, pos].astype("<u4").tobytes()
    out, start = [], 0
    for r, (m, w, end) in enumerate(zip(low.tolist(), width.tolist(), ends)):
        out.append(struct.pack("<IBB", m, w, end - start) + packed[r] + pos_raw[start:end] + high_raw[4 * start : 4 * end])
        start = end
    return out


def decode_blocks(raw: bytes, starts: list[int]) -> np.ndarray:
    """The ids of whole blocks that begin at ``starts`` within ``raw``."""
    n = len(starts)
    low, width = np.empty(n, dtype=np.uint32), np.empty(n, dtype=np.uint8)
    row, pos, high = [], [], []
    for r, s in enumerate(starts):
        low[r], width[r], exceptions = struct.unpack_from("<IBB", raw, s)
        if exceptions:
            p = s + 6 + BLOCK * int(width[r]) // 8
            row.append(np.full(exceptions, r))
            pos.append(np.frombuffer(raw, np.uint8, exceptions, p))
            high.append(np.frombuffer(raw, "<u4", exceptions, p + exceptions))
    off = np.zeros((n, BLOCK), dtype=np.uint32)
    for w in np.unique(width).tolist():
        if w:
            rows = np.flatnonzero(width == w)
            size = BLOCK * w // 8
            body = np.zeros((len(rows), size + 8), dtype=np.uint8)
            body[:, :size] = np.frombuffer(b"".join(raw[starts[r] + 6 : starts[r] + 6 + size] for r in rows.tolist()), np.uint8).reshape(-1, size)
            # eight bytes from every byte on: an id and the bits before it in its first byte
            words = np.ndarray((len(rows), size), "<u8", body, strides=(size + 8, 1))
            bit = np.arange(BLOCK) * w
            off[rows] = (words[:, bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << w) - 1)
    if row:
        r, p = np.concatenate(row), np.concatenate(pos)
        off[r, p] |= (np.concatenate(high).astype(np.uint64) << width[r].astype(np.uint64)).astype(np.uint32)
    return (off + low[:, None]).reshape(-1)


def _filesystem(where: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(where)


class ShardWriter:
    """Writes one shard under a task-attempt name, then moves it to its final name."""

    def __init__(self, where: str, name: str, attempt: str):
        self.fs, self.dir = _filesystem(where)
        self.fs.create_dir(self.dir, recursive=True)
        self.name, self.tmp = f"{self.dir}/{name}", f"{self.dir}/.{name}.{attempt}"
        self.out = self.fs.open_output_stream(self.tmp)
        self.out.write(MAGIC)
        self.at, self.n = len(MAGIC), 0
        self.starts: list[int] = []
        self.docs: list[int] = []
        self.nulls: list[int] = []
        self.counts: list[int] = []
        self.left: list[np.ndarray] = []
        self.waiting = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.counts.append(len(ids))
        self.left.append(ids)
        self.waiting += len(ids)
        self.n += len(ids)
        if self.waiting >= RUN:
            self._flush(self.waiting // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.left) if self.left else np.empty(0, np.uint32)
        for i in range(0, n, RUN):
            blocks = encode_blocks(ids[i : min(i + RUN, n)])
            for b in blocks:
                self.starts.append(self.at)
                self.at += len(b)
            self.out.write(b"".join(blocks))
        self.left, self.waiting = [ids[n:]], len(ids) - n

    def close(self) -> tuple[int, int, int, int]:
        self._flush(self.waiting)
        head = struct.pack("<QQQ", self.n, len(self.starts), len(self.docs))
        footer = zlib.compress(b"".join([head, np.array(self.starts, "<u8").tobytes(), np.array(self.docs, "<i8").tobytes(), np.array(self.nulls, "u1").tobytes(), np.array(self.counts, "<u8").tobytes()]), 1)
        self.out.write(footer + struct.pack("<Q", len(footer)) + MAGIC)
        self.out.close()
        self.fs.move(self.tmp, self.name)
        return len(self.docs), self.n, len(self.starts), self.at + len(footer) + 16


class ShardReader:
    """Reads documents or any id range of a shard through its block index."""

    def __init__(self, where: str, name: str):
        fs, path = _filesystem(where)
        self.file = fs.open_input_file(f"{path}/{name}")
        size = self.file.size()
        tail = self._at(size - 16, 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{name} is not a complete token file")
        (length,) = struct.unpack("<Q", tail[:8])
        self.end = size - 16 - length
        raw = zlib.decompress(self._at(self.end, length))
        self.n, blocks, docs = struct.unpack_from("<QQQ", raw)
        at = 24
        self.starts = np.frombuffer(raw, "<u8", blocks, at).astype(np.int64)
        self.docs = np.frombuffer(raw, "<i8", docs, at := at + 8 * blocks)
        self.nulls = np.frombuffer(raw, "u1", docs, at := at + 8 * docs)
        self.counts = np.frombuffer(raw, "<u8", docs, at + docs).astype(np.int64)

    def _at(self, start: int, n: int) -> bytes:
        self.file.seek(start)
        return self.file.read(n)

    def read(self, start: int, n: int) -> np.ndarray:
        """Ids ``start`` to ``start + n`` of the shard; decodes only the blocks that hold them."""
        n = max(0, min(n, self.n - start))
        if not n:
            return np.empty(0, dtype=np.uint32)
        a, b = start // BLOCK, -(-(start + n) // BLOCK)
        begin = int(self.starts[a])
        end = int(self.starts[b]) if b < len(self.starts) else self.end
        ids = decode_blocks(self._at(begin, end - begin), (self.starts[a:b] - begin).tolist())
        return ids[start - a * BLOCK :][:n]

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """(doc_id, first id within the shard, ids, crc32 of the ids' bytes), decoding a run at a time."""
        have, have_at = np.empty(0, dtype=np.uint32), 0
        start = 0
        for doc, null, n in zip(self.docs.tolist(), self.nulls.tolist(), self.counts.tolist()):
            crc, done = 0, 0
            while done < n:
                at = start + done
                if at >= have_at + len(have):
                    have, have_at = self.read(at - at % BLOCK, RUN), at - at % BLOCK
                part = have[at - have_at : start + n - have_at]
                crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                done += len(part)
            yield None if null else doc, start, n, crc
            start += n


def write_token_files(docs: DataFrame, where: str, tokenizer: str, shards: int, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> DataFrame:
    """Encode ``docs`` and write shard files to the shared folder ``where``; returns the manifest.

    Documents are range-partitioned and sorted by (id, text hash), null ids first; a null text
    is an empty one and repeated rows are each written.  ``end_id`` follows every document.
    A task writes its file under an attempt's name and moves it when complete, so a task that
    runs again after its executor was lost replaces the file with the same bytes.
    Memory per task: one Arrow batch of texts, the ids of ``BATCH_BYTES`` of them, ``RUN`` ids
    and 25 bytes a document.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.col("h").asc()]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text")).repartitionByRange(shards, *order).sortWithinPartitions(*order)

    def write(batches):
        context = TaskContext.get()
        shard = context.partitionId()
        name = f"shard-{shard:06d}.ktok"
        out, encoder = None, byte_encoder(tokenizer)
        for batch in batches:
            out = out or ShardWriter(where, name, str(context.taskAttemptId()))
            doc_ids = batch.column(0).to_pylist()
            for at, texts in batches_of(batch.column(1)):
                for k, ids in enumerate(encoder.encode(texts)):
                    out.add(doc_ids[at + k], np.append(ids, np.uint32(end_id)))
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(("shard", "file", "n_docs", "n_tokens", "n_blocks", "n_bytes"), (shard, name, *out.close())))], schema=_manifest_schema())

    return stage(map_arrow(rows.select("doc_id", "text"), write, MANIFEST), "token-manifest")


def _manifest_schema() -> pa.Schema:
    return pa.schema([("shard", pa.int32()), ("file", pa.string()), *((c, pa.int64()) for c in ("n_docs", "n_tokens", "n_blocks", "n_bytes"))])


def read_token_files(manifest: DataFrame, where: str) -> DataFrame:
    """Documents of the shard files: doc_id, start (ids before it in all shards), n_tokens, ids_crc32.

    Starts come from a running sum over the manifest, which has one row a shard.
    """
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    plan = manifest.select("shard", "file", F.coalesce(before, F.lit(0)).alias("base"))
    plan = plan.repartitionByRange(shuffle_partitions(manifest.sparkSession), "shard")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                found = []
                for doc_id, start, n, crc in ShardReader(where, row["file"]).documents():
                    found.append((doc_id, row["base"] + start, n, crc))
                    if len(found) == 8192:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*found), schema)], schema=schema)
                        found = []
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*found), schema)], schema=schema)

    return map_arrow(plan, read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_digests(spark: SparkSession, docs: DataFrame, tokenizer: str, shards: int | None = None) -> DataFrame:
    """Write ``docs`` as token files and return what reading them back gives, a row a document."""
    where = new_dir(spark, "tokens")
    manifest = write_token_files(docs, where, tokenizer, shards or shuffle_partitions(spark))
    return read_token_files(manifest, where)
