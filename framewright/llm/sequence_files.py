"""Token ids in Arrow files of equal-length sequences.

The documents' ids, in ascending id order, form one row of ids that is cut into sequences of equal
length.  A file is in Arrow's file form (a stream of record batches and a footer with their places), its
batches have two fixed-size-list columns, ``ids`` and ``mask``, and every batch but the last holds the same
number of sequences.  So sequence i is row i % k of batch i // k, and with the file mapped into
memory its ids and its mask are views of the file: nothing is parsed or copied (``SequenceFile``).  The mask is 1 for
an id and 0 for padding, which only a file's last sequence has.  Ids have two bytes where the vocabulary
allows, else four.  Beside each file an index of the same form holds ``doc_id``, ``start`` (within
the file) and ``n_tokens``.

Documents are dealt by range of (id, text hash, row number), so rows that share an id, or have none, are
spread as well; each task streams its documents into one file and returns one row about it.  File names
are unique to an attempt and only those in the returned table, which Spark commits, are ever read; a file of a
lost attempt stays unread.  The folder must be one that all machines share (``spark.checkpoint.dir``).

Defined results: a null text is empty (its end id alone); rows without an id come last; repeated rows are
written once for each row; an empty table gives no files.  Other columns are ignored.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewright.llm.bpe import PreTokens, Table
from framewright.llm.common import stored, texts
from framewright.session import shared_dir

#: Ids of a sequence, sequences of a batch, text bytes of a file (about), entries of a worker's cache.
LENGTH, BATCH, FILE_BYTES, CACHE_ENTRIES = 1024, 256, 64 << 20, 100_000

_FILES = "part int, path string, n_ids long, n_docs long"
_WORKER: dict = {}


def _encoder(path: str) -> tuple[PreTokens, Table]:
    if path not in _WORKER:
        pre = PreTokens(path)
        _WORKER[path] = pre, Table({}, lambda t: array("I", pre.token_ids(t)).tobytes(), CACHE_ENTRIES)
    return _WORKER[path]


def _opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    where = urlparse(path)
    if where.scheme in ("", "file"):
        return pyarrow.fs.LocalFileSystem(), where.path
    return pyarrow.fs.FileSystem.from_uri(path)


class SequenceWriter:
    """Streams ids into a file of equal-length sequences, and documents into its index."""

    def __init__(self, path: str, id_type: np.dtype, length: int = LENGTH, batch: int = BATCH):
        self.fs, where = _opened(path)
        self.fs.create_dir(os.path.dirname(where), recursive=True)
        self.length, self.batch, self.id_type = length, batch, np.dtype(id_type)
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(self.id_type), length)), ("mask", pa.list_(pa.uint8(), length))],
                                metadata={"length": str(length), "batch": str(batch)})
        self.out = self.fs.open_output_stream(where + ".arrow")
        self.file = pa.ipc.new_file(self.out, self.schema)
        self.index_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.index_out = self.fs.open_output_stream(where + ".index.arrow")
        self.index = pa.ipc.new_file(self.index_out, self.index_schema)
        self.held, self.waiting, self.docs, self.n_ids, self.n_docs = [], 0, [], 0, 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, self.n_ids, len(ids)))
        self.n_ids += len(ids)
        self.n_docs += 1
        self.held.append(ids.astype(self.id_type))
        self.waiting += len(ids)
        if self.waiting >= self.length * self.batch:
            self._flush(whole=True)
        if len(self.docs) >= 1 << 16:
            self._flush_index()

    def _flush(self, whole: bool) -> None:
        """Write full batches; at the end also the rest, its last sequence padded."""
        flat = np.concatenate(self.held) if self.held else np.empty(0, self.id_type)
        step, at = self.length * self.batch, 0
        while len(flat) - at >= step:
            self._write(flat[at:at + step], step)
            at += step
        if not whole and at < len(flat):
            self._write(flat[at:], len(flat) - at)
            at = len(flat)
        self.held, self.waiting = [flat[at:]], len(flat) - at

    def _write(self, ids: np.ndarray, used: int) -> None:
        rows = -(-used // self.length)
        values, mask = np.zeros(rows * self.length, self.id_type), np.zeros(rows * self.length, np.uint8)
        values[:used], mask[:used] = ids, 1
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (values, mask)]
        self.file.write_batch(pa.record_batch(lists, schema=self.schema))

    def _flush_index(self) -> None:
        if self.docs:
            self.index.write_batch(pa.record_batch([pa.array(c, pa.int64()) for c in zip(*self.docs)], schema=self.index_schema))
            self.docs = []

    def close(self) -> None:
        self._flush(whole=False)
        self._flush_index()
        for x in (self.file, self.out, self.index, self.index_out):
            x.close()


class SequenceFile:
    """Random access to the sequences of a file.  A file that this machine can map is not copied:
    the arrays returned are views of it."""

    def __init__(self, path: str):
        fs, where = _opened(path)
        open_ = pa.memory_map if isinstance(fs, pyarrow.fs.LocalFileSystem) else fs.open_input_file
        self.reader = pa.ipc.open_file(open_(where + ".arrow"))
        self.index = pa.ipc.open_file(open_(where + ".index.arrow"))
        meta = self.reader.schema.metadata
        self.length, self.batch = int(meta[b"length"]), int(meta[b"batch"])
        self._at, self._now = -1, None

    def __len__(self) -> int:
        n = self.reader.num_record_batches
        return (n - 1) * self.batch + self.reader.get_batch(n - 1).num_rows if n else 0

    def _columns(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        if k != self._at:
            b = self.reader.get_batch(k)
            self._at, self._now = k, tuple(b.column(c).values.to_numpy(zero_copy_only=True) for c in (0, 1))
        return self._now

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of a sequence."""
        ids, mask = self._columns(i // self.batch)
        a = (i % self.batch) * self.length
        return ids[a:a + self.length], mask[a:a + self.length]

    def ids(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids from a place in the file on, as views of its batches."""
        step = self.length * self.batch
        while n > 0:
            part = self._columns(start // step)[0][start % step:start % step + n]
            yield part
            start, n = start + len(part), n - len(part)

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        """``doc_id, start, n_tokens`` in the order of the file."""
        for k in range(self.index.num_record_batches):
            yield from zip(*(c.to_pylist() for c in self.index.get_batch(k).columns))


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, for the shuffle."""
    for b in batches:
        raw = [t.encode("utf-8", "surrogatepass") for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_pydict({
            "doc_id": b.column("doc_id"), "h": b.column("h"), "nth": b.column("nth"), "size": pa.array([len(x) for x in raw], pa.int32()),
            "packed": pa.array([pa.compress(x, codec="zstd", asbytes=True) for x in raw], pa.binary())})


def write_sequences(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0, length: int = LENGTH, batch: int = BATCH,
                    file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the documents' ids to files under ``folder``: ``part, path, n_ids, n_docs`` per file, in order."""
    spark = docs.sparkSession
    rows = texts(docs)
    total = rows.agg(F.sum(F.octet_length("text").cast("long") + 8)).first()[0] or 0
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), total // (1 << 20)), total // file_bytes)
    order = [F.col("doc_id").asc_nulls_last(), "h", "nth"]
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("nth", F.monotonically_increasing_id())
    rows = rows.mapInArrow(_squeezed, "doc_id long, h long, nth long, size int, packed binary")
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "size", "packed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre, table = _encoder(tokenizer)
        look, end = table.__getitem__, np.asarray([end_id], "<u4")
        vocabulary = pre.library.get_vocab_size(with_added_tokens=True)
        part, writer = TaskContext.get().partitionId(), None
        path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex[:12]}"
        for b in batches:
            for doc, size, packed in zip(*(c.to_pylist() for c in b.columns)):
                text = pa.decompress(packed, decompressed_size=size, codec="zstd", asbytes=True).decode("utf-8", "surrogatepass")
                if writer is None:
                    writer = SequenceWriter(path, np.dtype("<u2" if max(vocabulary, end_id + 1) <= 1 << 16 else "<u4"), length, batch)
                runs = pre.runs(text)
                ids = (np.asarray(pre.whole_ids(text), "<u4") if runs is None
                       else np.frombuffer(b"".join([b"".join(map(look, r)) for r in runs]), "<u4"))
                writer.add(doc, np.concatenate([ids, end]))
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [path],
                                              "n_ids": pa.array([writer.n_ids], pa.int64()), "n_docs": pa.array([writer.n_docs], pa.int64())})
    return stored(ranged.mapInArrow(run, _FILES), "sequence-files")


def read_documents(files: DataFrame) -> DataFrame:
    """Every document of the files: ``doc_id, start`` (ids of all documents before it), ``n_tokens,
    ids_crc32`` (of its ids as little-endian unsigned 32-bit numbers), each file by its own task."""
    # One row per file; its start is the sum of the ids in the files before it.
    base = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_ids")
    placed = stored(files.select("part", "path", base.alias("base")), "sequence-starts")
    n = max(1, placed.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, first in zip(b.column("path").to_pylist(), b.column("base").to_pylist()):
                file, out = SequenceFile(path), []
                for doc, start, size in file.documents():
                    crc = 0
                    for ids in file.ids(start, size):
                        crc = zlib.crc32(np.ascontiguousarray(ids, "<u4"), crc)
                    out.append((doc, first + start, size, crc))
                    if len(out) >= 8192:
                        yield _batch(out)
                        out = []
                if out:
                    yield _batch(out)
    return placed.repartitionByRange(n, "part").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def token_files(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes the documents and reads them back (the query's table)."""
    return read_documents(write_sequences(docs, tokenizer, shared_dir(docs.sparkSession, "sequences")))
