"""Token files: ids of every document, compressed one by one with a shared dictionary.

A dictionary of zstandard is trained once on serialized ids of a bounded sample of
documents and stored in the folder. Each file holds documents in ascending order of ids:

    magic "HWTK", version, width of an id in bytes, two zero bytes     8 bytes
    CRC-32 of the dictionary                                           4 bytes
    number of documents                                                4 bytes
    frames, one per document, each compressed alone                    ...
    index: for each document its id (or none), its frame's offset and
    size, and its number of ids                                        25 bytes each
    offset of the index                                                8 bytes

So one document is read by seeking to the index and its frame. A manifest names the files
with their first place, so what an interrupted task leaves behind is never read.

Defined results: a null text counts as empty and holds the end id alone; null ids come
first; equal ids follow each other by a hash of their texts; an empty table makes a
manifest without files.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.llm import common, token_ids

MAGIC, VERSION = b"HWTK", 1
HEAD = struct.Struct("<4sBBHII")
ENTRY = struct.Struct("<BqQII")
TAIL = struct.Struct("<Q")
#: Documents that the dictionary is trained on at most, ids of each, and the dictionary's size.
SAMPLE_DOCUMENTS, SAMPLE_IDS, DICTIONARY_BYTES = 2_000, 2_048, 64 << 10
LEVEL = 3
#: Compressed bytes after which a task starts another file.
FILE_BYTES = 64 << 20


@dataclass
class Packing:
    """How ids are serialized: their width and the shared dictionary."""

    width: int
    dictionary: bytes

    @property
    def check(self) -> int:
        return zlib.crc32(self.dictionary)

    def serialize(self, ids: bytes) -> bytes:
        """Unsigned 32-bit ids in the width of the file."""
        if self.width == 4:
            return ids
        wide = np.frombuffer(ids, "<u4")
        if len(wide) and wide.max() > 0xFFFF:
            raise ValueError("an id does not fit the width of the file")
        return wide.astype("<u2").tobytes()

    def restore(self, data: bytes) -> bytes:
        return data if self.width == 4 else np.frombuffer(data, "<u2").astype("<u4").tobytes()

    def _shared(self) -> zstandard.ZstdCompressionDict | None:
        return zstandard.ZstdCompressionDict(self.dictionary) if self.dictionary else None

    def compressor(self) -> zstandard.ZstdCompressor:
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=self._shared())

    def decompressor(self) -> zstandard.ZstdDecompressor:
        return zstandard.ZstdDecompressor(dict_data=self._shared())


def trained(docs: DataFrame, path: str, end_id: int, width: int) -> Packing:
    """A dictionary from a sample of at most ``SAMPLE_DOCUMENTS`` documents, the same in every run."""
    sample = common.sampled(docs.select("doc_id", "text"), SAMPLE_DOCUMENTS, "doc_id", "text").select("text")
    plain = Packing(width, b"")

    def ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = token_ids.encoder(path)
        for batch in batches:
            found = coder.encode(common.plain_texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [pa.array([plain.serialize(x[: 4 * SAMPLE_IDS]) for x in found], pa.binary())], names=["ids"]
            )

    found = sample.mapInArrow(ids, "ids binary").limit(SAMPLE_DOCUMENTS).collect()
    rows = [bytes(r.ids) for r in found if r.ids]
    # a dictionary needs a good number of samples; without them documents are compressed plainly
    if len(rows) < 20 or sum(map(len, rows)) < 10 * 1024:
        return plain
    size = min(DICTIONARY_BYTES, sum(map(len, rows)) // 8)
    try:
        return Packing(width, zstandard.train_dictionary(size, rows).as_bytes())
    except zstandard.ZstdError:  # samples too alike to learn from
        return plain


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme that Spark reads and writes it by."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return store.makeQualified(path).toString()


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a qualified path, and the path there."""
    if ":" not in path:
        raise ValueError(f"{path} names no file system; call qualified() first")
    try:
        return fs.FileSystem.from_uri(path)
    except pa.ArrowInvalid as error:
        raise ValueError(f"token files cannot be kept in {path}: no file system for its scheme in tasks") from error


class Writer:
    """Files of one task: each is written under a name of this attempt, then moved in place."""

    def __init__(self, folder: str, packing: Packing, part: int) -> None:
        self.store, self.folder = _place(folder)
        self.packing, self.part, self.number = packing, part, 0
        self.compressor = packing.compressor()
        self._open()

    def _open(self) -> None:
        self.frames, self.entries, self.at = [], [], HEAD.size

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.compressor.compress(self.packing.serialize(ids))
        self.entries.append((doc_id is not None, doc_id or 0, self.at, len(frame), len(ids) // 4))
        self.frames.append(frame)
        self.at += len(frame)

    def close(self) -> tuple[str, int, int] | None:
        """Write the file; its name, documents and ids."""
        if not self.entries:
            return None
        name = f"tokens-{self.part:06d}-{self.number:04d}.hwtk"
        attempt = f"{self.folder}/.{name}.{uuid.uuid4().hex}"
        with self.store.open_output_stream(attempt) as out:
            out.write(HEAD.pack(MAGIC, VERSION, self.packing.width, 0, self.packing.check, len(self.entries)))
            for frame in self.frames:
                out.write(frame)
            for entry in self.entries:
                out.write(ENTRY.pack(*entry))
            out.write(TAIL.pack(self.at))
        self.store.move(attempt, f"{self.folder}/{name}")
        done = name, len(self.entries), sum(e[4] for e in self.entries)
        self.number += 1
        self._open()
        return done


def write(docs: DataFrame, folder: str, path: str, end_id: int, width: int | None = None) -> None:
    """Write the ids of all documents, each with ``end_id`` behind, into ``folder``.

    Ids take ``width`` bytes, 2 or 4; by default the fewest that hold the vocabulary. An id
    that does not fit a given width raises.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    folder = qualified(spark, folder)
    if width is None:
        width = max(token_ids.encoder(path).width, 2 if end_id < 1 << 16 else 4)
    store, place = _place(folder)
    store.create_dir(f"{place}/files", recursive=True)
    packing = trained(docs, path, end_id, width)
    spark.createDataFrame(
        [(packing.width, bytearray(packing.dictionary))], "width int, dictionary binary"
    ).coalesce(1).write.parquet(f"{folder}/dictionary")
    end = struct.pack("<I", end_id)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = token_ids.encoder(path)
        writer = Writer(f"{folder}/files", packing, TaskContext.get().partitionId())

        def line(done: tuple[str, int, int] | None) -> Iterator[pa.RecordBatch]:
            if done:
                names = ["name", "documents", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in done], names=names)

        for batch in batches:
            found = coder.encode(common.plain_texts(batch.column("text")))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), found):
                writer.add(doc_id, ids + end)
                if writer.at >= FILE_BYTES:
                    yield from line(writer.close())
        yield from line(writer.close())

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    dealt = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    files = common.stored(dealt.mapInArrow(run, "name string, documents long, ids long"), "files")
    before = Window.orderBy("name").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    manifest = files.select(
        "name", "documents", "ids", F.coalesce(F.sum("ids").over(before), F.lit(0)).cast("long").alias("start")
    )
    manifest.write.parquet(f"{folder}/manifest")


def parse(data: bytes, packing: Packing) -> Iterator[tuple[int | None, bytes]]:
    """The documents of one file in order: id and ids."""
    magic, version, width, _, check, n = HEAD.unpack_from(data)
    if magic != MAGIC or version != VERSION or width != packing.width or check != packing.check:
        raise ValueError("the file does not belong to this dictionary")
    plain = packing.decompressor()
    (index,) = TAIL.unpack_from(data, len(data) - TAIL.size)
    view = memoryview(data)
    for i in range(n):
        has_id, doc_id, at, size, count = ENTRY.unpack_from(data, index + i * ENTRY.size)
        ids = packing.restore(plain.decompress(view[at : at + size], max_output_size=count * packing.width))
        if len(ids) != 4 * count:
            raise ValueError("a frame is damaged")
        yield (doc_id if has_id else None), ids


def stored_packing(spark: SparkSession, folder: str) -> Packing:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    return Packing(row.width, bytes(row.dictionary))


def document(folder: str, packing: Packing, name: str, place: int) -> bytes:
    """The ids of one document of a file, read by the index alone."""
    store, root = _place(folder)
    with store.open_input_file(f"{root}/files/{name}") as file:
        size = file.size()
        (index,) = TAIL.unpack(file.read_at(TAIL.size, size - TAIL.size))
        _, _, at, length, count = ENTRY.unpack(file.read_at(ENTRY.size, index + place * ENTRY.size))
        frame = file.read_at(length, at)
    return packing.restore(packing.decompressor().decompress(frame, max_output_size=count * packing.width))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of a folder: doc_id, start, n_tokens, ids_crc32 and ids.

    ``start`` counts the ids of all documents before. Files are opened by the tasks, one
    after another; ids are restored document by document.
    """
    folder = qualified(spark, folder)
    packing = stored_packing(spark, folder)
    files = spark.read.parquet(f"{folder}/manifest").select("name", "start")
    tasks = max(files.count(), 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _place(f"{folder}/files")
        for batch in batches:
            for name, start in zip(batch.column("name").to_pylist(), batch.column("start").to_pylist()):
                with store.open_input_file(f"{root}/{name}") as file:
                    data = file.read()
                rows: list[tuple] = []
                held = 0
                for doc_id, ids in parse(data, packing):
                    rows.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), ids))
                    start += len(ids) // 4
                    held += len(ids)
                    if held >= 4 << 20:
                        yield _rows(rows)
                        rows, held = [], 0
                yield _rows(rows)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"
    return files.repartitionByRange(tasks, "name").mapInArrow(run, schema)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.binary()]
    names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]
    columns = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def round_trip(docs: DataFrame, folder: str, path: str, end_id: int) -> DataFrame:
    """Write the files, and return what reading them back gives, without the ids."""
    write(docs, folder, path, end_id)
    return read(docs.sparkSession, folder).drop("ids")
