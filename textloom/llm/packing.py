"""Best-fit packing of documents into sequences of a fixed number of tokens.

Documents are cut only where they are longer than a sequence; the last piece may be
shorter.  Full pieces are sequences of their own.  All pieces together are packed by
best-fit decreasing: pieces go from the longest to the shortest, each into the open
sequence with the least room that still holds it.  The open sequences are leaves of a segment
tree over remaining room, so the tightest one is found in logarithmic time.

Pieces of one length are alike, so the packing is that of the counts of the lengths: there are at most ``size`` of them,
whatever the size of the table, and sequences with equal room take equal pieces together.  The driver gets the counts and makes a
list of placements (pieces 0..n of a length go to these sequences at these places), whose size depends on the lengths
alone.  Spark numbers the pieces of every length and looks up their places, so the result has exactly as many sequences
as best-fit decreasing over all pieces one by one.

``sequence_id`` follows the order of the documents, so a mix of sources stays a mix: sequences are numbered by the place of the
piece that opens them, and the places for pieces of one length are given out in the order of the sequences to the pieces in the
order of the documents.

Defined cases: a null text is empty and holds the end id only; repeated rows are packed
once each; a null ``doc_id`` is packed like any other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import blocks, pick, stored, with_place
from textloom.llm.tokens import crc, encoder, tokenizer_path
from textloom.operators.ordering import dense_index, exclusive_prefix

SEQUENCE_TOKENS = 2048
RUN_ROWS = 16_384
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, place_file string, place_row long"
PLACE = ["place_file", "place_row"]


class RoomTree:
    """A segment tree over rooms 0..size: which rooms some open sequence has left."""

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]

    def add(self, room: int, sequences: tuple[int, int]) -> None:
        self.open[room].append(sequences)
        node = room + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, least: int) -> tuple[int, tuple[int, int]] | None:
        """The smallest room of at least ``least`` with sequences (first, number) that have it, removed from the tree."""
        node = least + self.leaves
        if not self.count[node]:
            # up to the first ancestor that has an open leaf on its right, then down to the leftmost one
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        sequences = self.open[room].pop()
        while node:
            self.count[node] -= 1
            node >>= 1
        return room, sequences


def best_fit_decreasing(counts: dict[int, int], size: int) -> np.ndarray:
    """Placements of ``counts[length]`` pieces of each length, as rows (length, first, pieces, sequence, per, offset).

    The pieces ``first .. first + pieces`` of a length go to the sequences from ``sequence`` on, ``per`` to each, side by side
    from ``offset``.  A sequence with the least room stays the tightest one while it takes pieces of a length.
    """
    tree, opened, out = RoomTree(size), 0, []
    for length in sorted(counts, reverse=True):
        first, n = 0, counts[length]
        while n:
            found = tree.take(length)
            if found is None:
                many = -(-n // (size // length))
                found, opened = (size, (opened, many)), opened + many
            room, (sequence, many) = found
            per = room // length
            full = min(many, n // per)
            rest = n - full * per if full < many else 0  # of the last pieces of a length, in one more sequence
            for taken, each in ((full, per), (1, rest)):
                if taken * each:
                    out.append((length, first, taken * each, sequence, each, size - room))
                    first, n = first + taken * each, n - taken * each
                    if room > each * length:
                        tree.add(room - each * length, (sequence, taken))
                    sequence, many = sequence + taken, many - taken
            if many:
                tree.add(room, (sequence, many))
    return np.array(out, dtype=np.int64).reshape(-1, 6)


def token_pieces(
    docs: DataFrame, path: str | None = None, end_id: int = 0, size: int = SEQUENCE_TOKENS
) -> DataFrame:
    """One row per piece of each document's ids (with the end id), see ``PIECES``; whole texts are encoded."""
    path = path or tokenizer_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = encoder(path)
        for batch in blocks(batches, "text"):
            rows, source = [], []
            for i, (doc, ids) in enumerate(
                zip(batch.column("doc_id").to_pylist(), ready.encode(batch.column("text").to_pylist()), strict=True)
            ):
                ids = np.append(ids, np.uint32(end_id))
                for piece, at in enumerate(range(0, len(ids), size)):
                    part = ids[at : at + size]
                    rows.append((doc, piece, at, len(part), crc(part)))
                    source.append(i)
            columns = list(zip(*rows, strict=True))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            places = [batch.column(c).take(pa.array(source)) for c in PLACE]
            yield pa.RecordBatch.from_arrays(
                [*arrays, *places], ["doc_id", "piece", "start", "length", "ids_crc32", *PLACE]
            )

    return with_place(pick(docs, doc_id="long", text="string")).mapInArrow(cut, PIECES)


def _numbered(rows: DataFrame, buckets: list[str], order: list[str], counts: dict[int, int], out: str) -> DataFrame:
    """Adds the number of a row among those of its ``length``, from 0; ``buckets`` rise with ``order``."""
    lengths = sorted(counts)
    before = np.concatenate([[0], np.cumsum([counts[n] for n in lengths])])[:-1].tolist()
    base = rows.sparkSession.createDataFrame(list(zip(lengths, before, strict=True)), "length long, _base long")
    numbered = exclusive_prefix(rows, ["length", *buckets], order, {out: F.lit(1)})
    return numbered.join(F.broadcast(base), "length").withColumn(out, F.col(out) - F.col("_base")).drop("_base")


def pack(pieces: DataFrame, size: int = SEQUENCE_TOKENS, run_rows: int = RUN_ROWS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; needs ``doc_id``, ``piece`` and ``length`` and keeps all columns.

    The order of the documents is that of ``place_file`` and ``place_row``, which are dropped; without them it
    is the order of the rows.  ``pieces`` is used several times and should be cheap to read (a table or a checkpoint).
    """
    names = [c for c in pieces.columns if c not in PLACE]
    if not set(PLACE) <= set(pieces.columns):
        pieces = with_place(pieces)
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # size rows at most
    placements = best_fit_decreasing(counts, size)
    # a run of neighbouring documents is the unit of numbering
    run = F.floor(F.col("place_row") / run_rows).alias("_run")
    place = ["place_file", "_run", "place_row", "piece"]
    numbered = stored(_numbered(pieces.select("*", run), place[:2], place[2:], counts, "_number"), "pack-numbers")
    shipped = pieces.sparkSession.sparkContext.broadcast(placements)  # as many rows as ways to fill a sequence, whatever the table
    kept = ["length", *place]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = shipped.value[np.lexsort((shipped.value[:, 1], shipped.value[:, 0]))]
        lengths, starts = np.unique(rows[:, 0], return_index=True)
        ends = np.append(starts[1:], len(rows))
        for batch in batches:
            length, number = batch.column("length").to_numpy(), batch.column("_number").to_numpy()
            at = np.empty(batch.num_rows, dtype=np.int64)
            of = np.searchsorted(lengths, length)
            for i in np.unique(of).tolist():
                mine = of == i
                at[mine] = starts[i] + np.searchsorted(rows[starts[i] : ends[i], 1], number[mine], side="right") - 1
            _, first, _, sequence, per, offset = rows[at].T
            inner = number - first
            columns = [pa.array(sequence + inner // per), pa.array(offset + inner % per * length)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], [*kept, "_sequence", "offset"])

    schema = "length long, place_file string, _run long, place_row long, piece int, _sequence long, offset long"
    slots = stored(numbered.select(*kept, "_number").mapInArrow(look_up, schema), "pack-slots")
    # sequences in the order of the pieces that open them
    openers = dense_index(slots.where("offset = 0").select("_sequence", *place), place[:2], place[2:], "sequence_id")
    placed = slots.select("length", "_sequence", "offset").join(openers.select("_sequence", "sequence_id"), "_sequence")
    placed = placed.drop("_sequence").withColumn("_part", F.floor(F.col("sequence_id") / run_rows))
    given = _numbered(stored(placed, "pack-places"), ["_part"], ["sequence_id", "offset"], counts, "_number")
    return numbered.join(given.select("length", "_number", "sequence_id", "offset"), ["length", "_number"]).select(*names, "sequence_id", "offset")


def pack_documents(
    docs: DataFrame,
    path: str | None = None,
    end_id: int = 0,
    size: int = SEQUENCE_TOKENS,
    run_rows: int = RUN_ROWS,
) -> DataFrame:
    """Encode, cut and pack whole documents; texts are encoded once."""
    return pack(stored(token_pieces(docs, path, end_id, size), "pieces"), size, run_rows)
