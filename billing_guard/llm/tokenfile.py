"""Token-id files: one array of ids, document boundaries in Elias-Fano code.

A file is a little-endian id array (16 bits where the vocabulary allows, else 32)
beside an index.  The index holds, in Elias-Fano code, the documents' end offsets and
their ids (ascending): the low bits of each value packed, the high parts as a unary bit
array, plus every ``SAMPLE``-th one-bit's place.  ``select`` jumps to the sample and
counts bits from there, so an offset is found without a table of 64-bit offsets: about
2 + log2(ids per document) bits for each document.

Documents are range-partitioned by ascending doc_id and sorted inside each partition;
every task streams its documents into files of its own, named for the attempt, and
returns one manifest row per file.  The rows meet in one task and are written by Spark's
committer: files of lost attempts are in no manifest and never read.  Files go through
``pyarrow.fs`` into the given folder, which all executors must reach; a folder without a
scheme is the one that Spark means by it, on the session's default file system.  Small
files are read several to a task.

Edge cases: NULL and empty texts are documents of the end id alone; NULL ids come first;
repeated ids stand beside each other; an empty table writes no file and reads back as
no row; texts of any length are written whole; only doc_id and text are read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from billing_guard.llm.encode import WORD_BPE, encoder
from billing_guard.session import qualified

END_ID = 2
SAMPLE = 256                 # one-bits between select samples
FILE_IDS = 32_000_000        # a task begins a new file beyond so many ids
FILE_DOCS = 2_000_000        # ... or so many documents
READ_IDS = 4_000_000         # a task reads so many ids, or one file, on average
_MAGIC = b"TOKEF1\0\0"
_HEAD = struct.Struct("<8sQQQI")  # magic, documents, NULL ids, ids, bytes an id
_EF_HEAD = struct.Struct("<QQqI")  # values, bytes of high bits, least value, low bits
MANIFEST = "part int, roll int, ids_path string, index_path string, n_docs long, n_ids long"


class EliasFano:
    """A non-decreasing sequence of integers in near-minimal space."""

    def __init__(self, size: int, least: int, low_bits: int, low: np.ndarray, high: np.ndarray,
                 samples: np.ndarray):
        self.size, self.least, self.low_bits = size, least, low_bits
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.int64)
        size = len(values)
        least = int(values[0]) if size else 0
        # differences of int64 may need 64 bits
        shifted = values.astype(np.uint64) - np.uint64(least % 2**64)
        span = int(shifted[-1]) if size else 0
        low_bits = max(0, (span // size).bit_length() - 1) if size else 0
        low = np.zeros((size * low_bits + 7) // 8 * 8, np.uint8)
        for k in range(low_bits):
            low[k:size * low_bits:low_bits] = (shifted >> np.uint64(k)) & np.uint64(1)
        ones = (shifted >> np.uint64(low_bits)).astype(np.int64) + np.arange(size)
        bits = np.zeros(((int(ones[-1]) + 1 if size else 0) + 7) // 8 * 8, np.uint8)
        bits[ones] = 1
        return cls(size, least, low_bits, np.packbits(low, bitorder="little"),
                   np.packbits(bits, bitorder="little"), ones[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        return (_EF_HEAD.pack(self.size, len(self.high), self.least, self.low_bits)
                + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes())

    @classmethod
    def from_bytes(cls, data: memoryview) -> tuple[EliasFano, int]:
        """The sequence and how many bytes it took."""
        size, high_bytes, least, low_bits = _EF_HEAD.unpack_from(data)
        at = _EF_HEAD.size
        parts = []
        for count, kind in (((size * low_bits + 7) // 8, np.uint8), (high_bytes, np.uint8),
                            (-(-size // SAMPLE), np.dtype("<u4"))):
            parts.append(np.frombuffer(data, kind, count, at))
            at += parts[-1].nbytes
        return cls(size, least, low_bits, *parts), at

    def select(self, i: int) -> int:
        """Value number ``i``: one sample, then counting bits."""
        place = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        byte = place // 8
        bits = int(self.high[byte]) >> (place % 8) << (place % 8)
        while (ones := bits.bit_count()) <= left:
            left -= ones
            byte += 1
            bits = int(self.high[byte])
        for _ in range(left):
            bits &= bits - 1
        high = byte * 8 + (bits & -bits).bit_length() - 1 - i
        low = 0
        for k in range(self.low_bits):
            at = i * self.low_bits + k
            low |= (int(self.low[at >> 3]) >> (at & 7) & 1) << k
        return self.least + (high << self.low_bits | low)

    def values(self) -> np.ndarray:
        """All values at once."""
        return self.run(0, self.size)

    def run(self, first: int, last: int) -> np.ndarray:
        """Values ``first`` to ``last``, read on from the sample before them."""
        if first >= last:
            return np.zeros(0, np.int64)
        sample, after = first // SAMPLE, -(-last // SAMPLE)
        byte = int(self.samples[sample]) // 8
        end = int(self.samples[after]) // 8 + 1 if after < len(self.samples) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[byte:end], bitorder="little")) + byte * 8
        skip = int(np.searchsorted(ones, self.samples[sample])) + first - sample * SAMPLE
        high = ones[skip:skip + last - first] - np.arange(first, last)
        out = high.astype(np.uint64) << np.uint64(self.low_bits)
        at = first * self.low_bits
        bits = np.unpackbits(self.low[at // 8:(last * self.low_bits + 7) // 8], bitorder="little")
        bits = bits[at % 8:at % 8 + (last - first) * self.low_bits]
        for k in range(self.low_bits):
            out |= bits[k::self.low_bits].astype(np.uint64) << np.uint64(k)
        return (out + np.uint64(self.least % 2**64)).astype(np.int64)


def open_path(path: str):
    """The file system and the path in it."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path[len("file:"):])
    return fs.LocalFileSystem(), path


class _Writer:
    """One pair of files: ids as they come, the index at the end."""

    def __init__(self, folder: str, part: int, roll: int, width: int):
        name = f"{folder.rstrip('/')}/ids-{part:05d}-{roll:03d}-{uuid.uuid4().hex[:12]}"
        self.part, self.roll, self.width = part, roll, width
        self.ids_path, self.index_path = name + ".bin", name + ".idx"
        self.store, inner = open_path(self.ids_path)
        self.store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        self.stream = self.store.open_output_stream(inner)
        self.sizes: list[int] = []
        self.doc_ids: list[int] = []
        self.nulls = self.total = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.stream.write(ids.astype(f"<u{self.width}").tobytes())
        self.sizes.append(len(ids))
        self.total += len(ids)
        if doc_id is None:
            self.nulls += 1
        else:
            self.doc_ids.append(doc_id)

    def close(self) -> tuple:
        self.stream.close()
        ends = EliasFano.encode(np.cumsum(np.array(self.sizes, np.int64)))
        doc_ids = EliasFano.encode(np.array(self.doc_ids, np.int64))
        head = _HEAD.pack(_MAGIC, len(self.sizes), self.nulls, self.total, self.width)
        with self.store.open_output_stream(open_path(self.index_path)[1]) as out:
            out.write(head + ends.to_bytes() + doc_ids.to_bytes())
        return (self.part, self.roll, self.ids_path, self.index_path, len(self.sizes), self.total)


class TokenFile:
    """Random access to a written file: ``offset(i)`` and ``ids(i)``."""

    def __init__(self, ids_path: str, index_path: str):
        store, inner = open_path(index_path)
        with store.open_input_stream(inner) as f:
            data = memoryview(f.read())
        magic, self.n_docs, self.nulls, self.n_ids, self.width = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError(f"{index_path} is no token index")
        self.ends, used = EliasFano.from_bytes(data[_HEAD.size:])
        self.doc_ids, _ = EliasFano.from_bytes(data[_HEAD.size + used:])
        self.ids_path = ids_path

    def offset(self, i: int) -> int:
        """Ids of this file before document ``i``."""
        return self.ends.select(i - 1) if i else 0

    def reach(self, first: int, ids: int) -> int:
        """The document after ``first`` and all that end within so many ids from its start;
        ``first`` itself is always taken."""
        most = self.offset(first) + ids
        low, high = first + 1, self.n_docs
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.offset(middle) <= most else (low, middle - 1)
        return low

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.doc_ids.select(i - self.nulls)

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids from offset ``first`` to ``last`` of this file."""
        store, inner = open_path(self.ids_path)
        with store.open_input_file(inner) as f:
            return np.frombuffer(f.read_at((last - first) * self.width, first * self.width),
                                 f"<u{self.width}")


def write_token_files(docs: DataFrame, folder: str, vocabulary: str = WORD_BPE, end_id: int = END_ID,
                      path: str | None = None, file_ids: int = FILE_IDS,
                      file_docs: int = FILE_DOCS) -> DataFrame:
    """Write all documents in ascending doc_id order; the manifest, as a written table."""
    folder = qualified(docs.sparkSession, folder)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary, path)
        width = 2 if max(encode.library.get_vocab_size(), end_id + 1) <= 2**16 else 4
        end = np.array([end_id], "<u4")
        part = TaskContext.get().partitionId()
        writer, done = None, []
        for batch in batches:
            missing = batch["doc_id"].isna().to_numpy()
            for doc_id, null, text in zip(batch["doc_id"], missing, batch["text"]):
                if writer is None or writer.total >= file_ids or len(writer.sizes) >= file_docs:
                    if writer is not None:
                        done.append(writer.close())
                    writer = _Writer(folder, part, len(done), width)
                writer.add(None if null else int(doc_id),
                           np.concatenate([np.frombuffer(encode(text), "<u4"), end]))
        if writer is not None:
            done.append(writer.close())
        yield pd.DataFrame(done, columns=["part", "roll", "ids_path", "index_path", "n_docs", "n_ids"])

    # ids as strings: pandas would make doubles of a column that holds NULLs
    rows = (docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
            .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
            .select(F.col("doc_id").cast("string").alias("doc_id"), "text"))
    manifest = f"{folder.rstrip('/')}/manifest"
    # one row for each file, met in a single task: not a part file (and its checksum) for each
    rows.mapInPandas(write, MANIFEST).repartition(1).write.parquet(manifest)
    return docs.sparkSession.read.schema(MANIFEST).parquet(manifest)


def read_token_files(manifest: DataFrame, chunk_ids: int = 4_000_000,
                     read_ids: int = READ_IDS) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone."""
    # one row for each file: a running sum over the manifest, not over documents
    before = Window.orderBy("part", "roll").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    size = manifest.agg(F.count(F.lit(1)).alias("files"), F.sum("n_ids").alias("ids")).first()
    spread = files.repartition(max(1, min(size["files"], -(-(size["ids"] or 0) // read_ids))))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                file = TokenFile(row.ids_path, row.index_path)
                doc = 0
                while doc < file.n_docs:
                    last = file.reach(doc, chunk_ids)
                    shift, ends = file.offset(doc), file.ends.run(doc, last)
                    starts = np.concatenate([np.array([shift], np.int64), ends[:-1]])
                    ids = file.ids(shift, int(ends[-1])).astype("<u4")
                    crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts - shift, ends - shift)]
                    known = file.doc_ids.run(max(0, doc - file.nulls), max(0, last - file.nulls))
                    names = [*[None] * (last - doc - len(known)), *known.tolist()]
                    yield pd.DataFrame({
                        "doc_id": pd.array(names, dtype="Int64"), "start": starts + row.base,
                        "n_tokens": ends - starts, "ids_crc32": crc})
                    doc = last

    return spread.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
