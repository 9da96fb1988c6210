"""Token-id files of independent zstandard frames with a seek table (operator 7).

A file is a sequence of zstandard frames, each holding some whole documents,
then one skippable frame with a directory, then the seek table of the public
"zstd seekable format" (a skippable frame: compressed size, decompressed size
and checksum of each frame, then the footer). Any zstandard tool can decompress
the file; a reader of single documents reads the footer, the directory and
only the frames it needs, and verifies each against its checksum.

Frame content, little endian: u32 documents; for each u8 (1 if its id is
null), i64 id, u64 number of ids; then all ids as u32. Directory, for each
frame: i64 first id, i64 last id, u64 documents, u64 ids.

Writing: documents are range-partitioned and sorted by id, each task encodes
its range and writes one file under a temporary name, then renames it, so a
repeated task leaves the same file. Tasks return a manifest row per file, which
is written as a table; reading starts from it. Null ids come first; equal ids
are ordered by text; null text is empty. An empty table gives no files.
"""

from __future__ import annotations

import struct

import numpy as np
from pyarrow.fs import FileSelector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import by_value, map_batches, text_slices
from .tokens import ENCODE_BYTES, END_ID, ChunkEncoder

by_value(__name__)

FRAME_IDS = 65_536  # a frame is closed once it holds as many ids
RANGE_CHARS = 48  # of a text that tell rows of one id apart where files begin; a file sorts by whole texts
# fixed values of the zstandard seekable format
SKIPPABLE_DIRECTORY = 0x184D2A5D
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

MANIFEST = "shard int, path string, n_docs bigint, n_ids bigint, n_frames bigint, bytes bigint"


def open_fs(uri: str):
    """The pyarrow file system and the path within it, for any URI that pyarrow reads."""
    import re

    from pyarrow import fs

    uri = re.sub(r"^file:/+", "file:///", uri)
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


class SeekableWriter:
    """Appends documents to an open binary file; ``close`` writes directory and seek table."""

    def __init__(self, out, frame_ids: int = FRAME_IDS, level: int = 3):
        import zstandard

        self.out, self.frame_ids, self.zstd = out, frame_ids, zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.docs: list[tuple[int | None, bytes]] = []
        self.held = self.n_docs = self.n_ids = self.bytes = 0
        self.seek: list[tuple[int, int, int]] = []
        self.directory: list[tuple[int, int, int, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id, ids))
        self.held += len(ids) // 4
        if self.held >= self.frame_ids:
            self.flush()

    def flush(self) -> None:
        import xxhash

        if not self.docs:
            return
        head = b"".join(struct.pack("<BqQ", d is None, d or 0, len(i) // 4) for d, i in self.docs)
        raw = b"".join([struct.pack("<I", len(self.docs)), head, *(i for _, i in self.docs)])
        frame = self.zstd.compress(raw)
        self._put(frame)
        self.seek.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        low = -(2**63)
        first, last = (low if d is None else d for d in (self.docs[0][0], self.docs[-1][0]))
        self.directory.append((first, last, len(self.docs), self.held))
        self.n_docs += len(self.docs)
        self.n_ids += self.held
        self.docs, self.held = [], 0

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def close(self) -> None:
        self.flush()
        body = b"".join(struct.pack("<qqQQ", *x) for x in self.directory)
        self._put(struct.pack("<II", SKIPPABLE_DIRECTORY, len(body)) + body)
        entries = [*self.seek, (8 + len(body), 0, 0)]
        table = b"".join(struct.pack("<III", *x) for x in entries) + struct.pack("<IBI", len(entries), 0x80, SEEKABLE_MAGIC)
        self._put(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(table)) + table)


class SeekableReader:
    """Random access to a file; reads the tail once, then only the frames asked for."""

    def __init__(self, source, size: int):
        self.source = source
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or flags != 0x80:
            raise ValueError("not a seekable token file")
        table = self._at(size - 9 - 12 * n, 12 * n)
        entries = np.frombuffer(table, dtype="<u4").reshape(n, 3).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(entries[:, 0])])
        self.frames, self.starts = entries[:-1], starts
        body = self._at(int(starts[n - 1]) + 8, int(entries[-1, 0]) - 8)
        self.directory = np.frombuffer(body, dtype=[("first", "<i8"), ("last", "<i8"), ("docs", "<u8"), ("ids", "<u8")])

    def _at(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def frame(self, k: int) -> list[tuple[int | None, bytes]]:
        """The (id, ids as bytes) of frame ``k``, after its checksum was verified."""
        import xxhash
        import zstandard

        size, raw_size, check = (int(x) for x in self.frames[k])
        raw = zstandard.ZstdDecompressor().decompress(self._at(int(self.starts[k]), size), max_output_size=raw_size)
        if len(raw) != raw_size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k}: checksum does not match")
        (n,) = struct.unpack_from("<I", raw)
        heads = [struct.unpack_from("<BqQ", raw, 4 + 17 * i) for i in range(n)]
        at, out = 4 + 17 * n, []
        for null, doc_id, length in heads:
            out.append((None if null else doc_id, raw[at : at + 4 * length]))
            at += 4 * length
        return out

    def frames_of(self, doc_id: int) -> range:
        """The frames whose range holds this id."""
        lo = int(np.searchsorted(self.directory["last"], doc_id, side="left"))
        return range(lo, max(lo, int(np.searchsorted(self.directory["first"], doc_id, side="right"))))

    def find(self, doc_id: int) -> list[bytes]:
        """The ids of every document with this id; decompresses only frames whose range holds it."""
        return [ids for k in self.frames_of(doc_id) for d, ids in self.frame(k) if d == doc_id]


def write_token_files(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text",
                      tokenizer: str | None = None, frame_ids: int = FRAME_IDS) -> DataFrame:
    """Write ``docs`` to files under ``folder``; returns the manifest (written there as a table, too)."""

    def write(batches):
        import uuid

        import pyarrow as pa
        from pyspark import TaskContext

        shard, writer, out = TaskContext.get().partitionId(), None, None
        fs, base = open_fs(folder)
        path = f"{base}/ids/shard-{shard:07d}.zst"
        tmp = f"{path}.{uuid.uuid4().hex}.tmp"
        enc, end = ChunkEncoder(tokenizer), np.asarray([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            for at, n in text_slices(batch, "text", ENCODE_BYTES):
                part = batch.slice(at, n)
                if writer is None and n:
                    fs.create_dir(f"{base}/ids", recursive=True)
                    out = fs.open_output_stream(tmp)
                    writer = SeekableWriter(out, frame_ids)
                flat, offsets = enc.encode(part.column(1))
                for key, lo, hi in zip(part.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                    writer.add(key, flat[lo:hi].tobytes() + end)
        if writer is None:
            return
        writer.close()
        out.close()
        fs.move(tmp, path)
        row = [[shard], [f"shard-{shard:07d}.zst"], [writer.n_docs], [writer.n_ids], [len(writer.seek)], [writer.bytes]]
        kinds = [pa.int32(), pa.string(), *[pa.int64()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], ["shard", "path", "n_docs", "n_ids", "n_frames", "bytes"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    # rows of one id, or of none, spread by the first letters of their texts, too
    rows = rows.repartitionByRange("doc_id", F.substring("text", 1, RANGE_CHARS)).sortWithinPartitions("doc_id", "text")
    map_batches(rows, write, MANIFEST).write.parquet(f"{folder}/manifest")
    fs, base = open_fs(folder)
    for left in fs.get_file_info(FileSelector(f"{base}/ids", allow_not_found=True)):
        if left.path.endswith(".tmp"):  # of a task that failed and was run again
            fs.delete_file(left.path)
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_token_files(spark: SparkSession, folder: str, only: list[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files, ids as little-endian u32 bytes;
    ``start`` counts the ids of all documents before it, over all files. With a list ``only`` of
    ids, nothing but the frames that may hold them is read and decompressed."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.select("shard", "path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))

    def read(batches):
        import pyarrow as pa

        fs, base = open_fs(folder)
        for batch in batches:
            for name, start in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                path = f"{base}/ids/{name}"
                with fs.open_input_file(path) as source:
                    reader = SeekableReader(source, source.size())
                    before = start + np.concatenate([[0], np.cumsum(reader.directory["ids"].astype(np.int64))])
                    wanted = range(len(reader.frames)) if only is None else sorted({k for d in only for k in reader.frames_of(d)})
                    for k in wanted:
                        docs = reader.frame(k)
                        n = np.asarray([len(i) // 4 for _, i in docs], dtype=np.int64)
                        at = before[k] + np.concatenate([[0], np.cumsum(n)[:-1]])
                        if only is not None:
                            own = [i for i, (d, _) in enumerate(docs) if d in only]
                            docs, n, at = [docs[i] for i in own], n[own], at[own]
                        arrays = [pa.array([d for d, _ in docs], pa.int64()), pa.array(at.astype(np.int64)), pa.array(n), pa.array([i for _, i in docs], pa.binary())]
                        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids"])

    return map_batches(files.repartitionByRange(max(1, manifest.count()), "shard"), read, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def token_files(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write ``docs`` and read the files back: (doc_id, start, n_tokens, ids)."""
    folder = folder or scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, folder, **options)
    return read_token_files(docs.sparkSession, folder)
