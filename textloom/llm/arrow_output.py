"""Token ids as Arrow files of equal-length sequences, with zero-copy access.

Documents (their ids and an end id) stand in ascending ``doc_id`` order.  The order is
cut into ranges of similar text size; each range is one file in the random-access form of the
Arrow stream (record batches and a footer) with the columns

* ``input_ids``  fixed-size list of ids, unsigned 16-bit if the vocabulary allows, else 32-bit,
* ``mask``       fixed-size list of booleans, false on the padding after a file's last id,
* ``documents``  list of (doc_id, at): the documents that begin in the sequence, and where.

``open_shard`` maps a local file into memory; ids of any sequence are a view of the mapped bytes.

Texts are encoded once and their ids shuffled once, to their range; a range is sorted and
streamed into its file batch by batch.  The bounds of the ranges are quantiles of (doc_id, hash of the
text), so many rows with one id still spread.  A file is written under a temporary name, then
renamed; its bytes depend on the input only, so tasks can be repeated at any time.

Defined cases: a null text is empty and still has its end id; rows with the same ``doc_id``
are separate documents, ordered by a hash of the text; a null ``doc_id`` comes first; an empty
table writes no file and reads back as no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import blocks, pick, stored
from textloom.llm.tokens import crc, encoder, tokenizer_path
from textloom.session import scratch_path

LENGTH = 2048
SHARD_CHARS = 16_000_000
BATCH = 128
DOCUMENTS = pa.list_(pa.struct([("doc_id", pa.int64()), ("at", pa.int32())]))


class Shards(NamedTuple):
    """A written set of files: (shard, file, n_ids, n_documents, first_id) per file, and the sequence length."""

    index: DataFrame
    length: int


def shard_schema(width: int, length: int) -> pa.Schema:
    ids = pa.uint16() if width == 2 else pa.uint32()
    return pa.schema(
        [("input_ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length)), ("documents", DOCUMENTS)]
    )


class ShardWriter:
    """Streams documents into one file; memory holds one record batch and one document."""

    def __init__(self, uri: str, width: int, length: int) -> None:
        self.fs, self.path = pafs.FileSystem.from_uri(uri)
        self.part = f"{self.path}.{uuid.uuid4().hex}.part"
        self.width, self.length, self.schema = width, length, shard_schema(width, length)
        self.out = self.fs.open_output_stream(self.part)
        self.writer = pa.ipc.new_file(self.out, self.schema)
        self.buffer = bytearray()
        self.begins: list[tuple[int, int | None]] = []  # (place in the buffer, doc_id)
        self.n_ids = self.n_documents = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.begins.append((len(self.buffer) // self.width, doc_id))
        self.buffer += ids
        self.n_ids += len(ids) // self.width
        self.n_documents += 1
        step = BATCH * self.length
        while len(self.buffer) >= step * self.width:
            self._batch(step)

    def _batch(self, n: int) -> None:
        rows = -(-n // self.length)
        ids = np.zeros(rows * self.length, dtype=f"<u{self.width}")
        ids[:n] = np.frombuffer(self.buffer, f"<u{self.width}", n)
        mask = np.arange(len(ids)) < n
        documents: list[list[dict]] = [[] for _ in range(rows)]
        while self.begins and self.begins[0][0] < n:
            at, doc_id = self.begins.pop(0)
            documents[at // self.length].append({"doc_id": doc_id, "at": at % self.length})
        self.begins = [(at - n, doc_id) for at, doc_id in self.begins]
        del self.buffer[: n * self.width]
        self.writer.write_batch(
            pa.RecordBatch.from_arrays(
                [
                    pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length),
                    pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length),
                    pa.array(documents, DOCUMENTS),
                ],
                schema=self.schema,
            )
        )

    def close(self) -> None:
        if self.buffer:
            self._batch(len(self.buffer) // self.width)
        self.writer.close()
        self.out.close()
        self.fs.move(self.part, self.path)


def open_shard(uri: str) -> pa.ipc.RecordBatchFileReader:
    """A file's reader; local files are mapped, so batches are views of the file."""
    fs, path = pafs.FileSystem.from_uri(uri)
    source = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
    return pa.ipc.open_file(source)


def sequence(reader: pa.ipc.RecordBatchFileReader, number: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, mask) of one sequence of a file; the ids are not copied."""
    batch = reader.get_batch(number // BATCH)
    length, row = batch.schema.field("input_ids").type.list_size, number % BATCH
    ids = batch.column("input_ids").values.to_numpy(zero_copy_only=True)
    mask = batch.column("mask").values[row * length : (row + 1) * length].to_numpy(zero_copy_only=False)
    return ids[row * length : (row + 1) * length], mask


def _range_key() -> F.Column:
    """Rises with ``doc_id``; among equal ids it spreads over [0, 1) by a hash of the text.  Null is lowest."""
    spread = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    low = F.lit(float(-(1 << 63))) * 4
    return F.coalesce(F.col("doc_id").cast("double"), low * (2 - spread)) + spread


def write_shards(
    docs: DataFrame,
    path: str | None = None,
    end_id: int = 1,
    length: int = LENGTH,
    shard_chars: int = SHARD_CHARS,
    folder: str | None = None,
) -> Shards:
    """Encode whole texts and write them; ``folder`` is one that all executors reach (default: a new shared one)."""
    spark = docs.sparkSession
    path, folder = path or tokenizer_path(), folder or scratch_path(spark, "arrow-shards")
    root, base = pafs.FileSystem.from_uri(folder)
    root.create_dir(base, recursive=True)
    rows = pick(docs, doc_id="long", text="string").withColumn("key", _range_key())
    size = rows.agg(F.sum(F.length("text")).alias("chars"), F.count("*").alias("n")).first()
    shards = max(1, -(-((size["chars"] or 0) + size["n"]) // shard_chars))
    steps = [i / shards for i in range(1, shards)]
    bounds = sorted(set(rows.approxQuantile("key", steps, 0.1 / shards))) if steps and size["n"] else []

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = encoder(path)
        width = 2 if max(ready.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        for batch in blocks(batches, "text"):
            ids = [
                np.append(x, np.uint32(end_id)).astype(f"<u{width}").tobytes()
                for x in ready.encode(batch.column("text").to_pylist())
            ]
            key = batch.column("key").to_numpy(zero_copy_only=False)
            shard = np.searchsorted(np.array(bounds, dtype=float), key, side="left")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard, pa.int32()),
                    batch.column("key"),
                    batch.column("doc_id"),
                    pa.array([width] * len(ids), pa.int32()),
                    pa.array(ids, pa.binary()),
                ],
                ["shard", "key", "doc_id", "width", "ids"],
            )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, shard, done = None, None, []

        def finish() -> None:
            writer.close()
            done.append((shard, f"{folder}/shard-{shard:08d}.arrow", writer.n_ids, writer.n_documents))

        for batch in blocks(batches, "ids"):
            for number, width, doc_id, ids in zip(
                *(batch.column(c).to_pylist() for c in ("shard", "width", "doc_id", "ids")), strict=True
            ):
                if number != shard:
                    if writer:
                        finish()
                    shard = number
                    writer = ShardWriter(f"{folder}/shard-{shard:08d}.arrow", width, length)
                writer.add(doc_id, ids)
        if writer:
            finish()
            columns = zip(*done, strict=True)
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["shard", "file", "n_ids", "n_documents"]
            )

    encoded = rows.mapInArrow(encode, "shard int, key double, doc_id long, width int, ids binary")
    ranges = encoded.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", "doc_id", "key")
    written = stored(ranges.mapInArrow(write, "shard int, file string, n_ids long, n_documents long"), "arrow-index")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return Shards(written.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0))), length)


def read_documents(shards: Shards, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files; ids as an array on request."""
    length = shards.length

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _documents_of(row["file"], row["first_id"], length, with_ids)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    files = shards.index.select("file", "first_id")
    spread = files.repartition(max(1, min(files.count(), 10_000)), "file")
    return spread.mapInArrow(read, schema)


def _documents_of(file: str, first: int, length: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    reader = open_shard(file)
    doc_id, start, rest = None, None, []  # the open document: where it begins and its ids so far
    seen = 0

    def closed(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))[: 4 + with_ids]
        names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 4 + with_ids]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def document() -> tuple:
        ids = np.concatenate(rest)
        return (doc_id, first + start, len(ids), crc(ids), *([ids.astype(np.int64)] if with_ids else []))

    for number in range(reader.num_record_batches):
        batch = reader.get_batch(number)
        ids = batch.column("input_ids").values.to_numpy(zero_copy_only=True)
        valid = int(np.count_nonzero(batch.column("mask").values.to_numpy(zero_copy_only=False)))
        found, at = [], 0
        for row, begins in enumerate(batch.column("documents").to_pylist()):
            for begin in begins:
                place = row * length + begin["at"]
                if start is not None:
                    rest.append(ids[at:place])
                    found.append(document())
                doc_id, start, rest, at = begin["doc_id"], seen + place, [], place
        rest.append(ids[at:valid])
        seen += valid
        if found:
            yield closed(found)
    if start is not None:
        yield closed([document()])
