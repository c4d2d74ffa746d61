"""Removing long repeats: windows of words that an earlier document also holds, found by recompression.

A text is a string of word symbols.  A round replaces every run of one symbol by a symbol for (symbol, length), then deals all
symbols to a left and a right half by their names and replaces every left symbol followed by a right one by a symbol for the
pair.  The name of a run or pair is a 64-bit function of its parts, the same in every task, so equal stretches of words get
equal symbols but at their edges.  Each symbol carries its context: the words that fix it whatever stands around them.
A window that covers the context of a symbol thus holds that symbol wherever it is repeated.

1. A first pass takes the digest of each text's words, the name of the whole text.  Equal texts form one class, which stands
   for its smallest id; the others of a class with a window are covered entirely.
2. Spark groups the symbols of the last round by name over all classes and finds the names that two classes share.
   A third of the names serve as anchors, the same third everywhere.
3. A window that covers the context of an anchor no other class has cannot be a repeat.  All other windows, those without an
   anchor too, are verified by a 128-bit fingerprint of their words: Spark groups them and takes the smallest id.
4. The words under windows with a smaller id elsewhere go.

Names only select windows, so a collision of names costs a comparison, never a word.  Fingerprints use two independent hashes
of each word; among 10^13 windows two different ones agree with a probability below 10^-9.

Nothing is gathered per symbol, class of copies or document: tasks ship arrays by hash bucket, whose number follows from the
counted words.  A symbol or window that several texts of one map block hold is settled there and shipped once for all of
them, so a name in a third of all documents costs one entry for every block, not one for every document.

Defined cases: a null or wordless text has no words; a text shorter than a window keeps all its words; a null ``doc_id``
counts as larger than all ids and is returned as null; rows of equal ``doc_id`` never cover each other, and each row
gets its own result; a document never covers itself; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import blocks, pick, stored
from textloom.llm.words import BY_SPACE, U64, find_words, hash_words, joined, mix, text_bytes

WINDOW = 50
ONE_IN = 3
BLOCK_BYTES = 2 << 20
FLUSH = 1_000_000
BUCKET_WORDS = 2_000_000
LAST = (1 << 63) - 1
NEVER = 1 << 48
EMPTY = hashlib.sha256(b"").hexdigest()
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD95)  # both 5 modulo 8: their powers repeat as late as powers can


def rounds_for(window: int) -> int:
    """So many rounds that the context of a symbol takes about half a window."""
    return max(1, int(math.log((window / 2 + 9) / 10) / math.log(4 / 3)))


def recompress(words: np.ndarray, bounds: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(name, text, low, high) of the symbols after ``rounds`` rounds.

    ``low`` and ``high`` bound the words that fix a symbol; a symbol at the edge of its text is fixed by no window.
    """
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    name, low = words, np.arange(len(words))
    high = low + 1
    for _ in range(rounds):
        # runs: fixed only together with the symbols beside them
        opens = np.ones(len(name), dtype=bool)
        opens[1:] = (text[1:] != text[:-1]) | (name[1:] != name[:-1])
        at = np.flatnonzero(opens)
        length = np.diff(np.append(at, len(name)))
        owner = text[at]
        edge = np.ones(len(at) + 1, dtype=bool)
        edge[1:-1] = owner[1:] != owner[:-1]
        before, after = np.append(low, 0)[at - 1], np.append(high, 0)[at + length]
        symbol = name[at]
        long = length > 1
        symbol[long] = mix(mix(symbol[long]) + length[long].astype(U64))
        name, text = symbol, owner
        low, high = np.where(edge[:-1], -NEVER, before), np.where(edge[1:], NEVER, after)
        # pairs: a left symbol takes the right symbol after it
        left = mix(name + U64(0x5851F42D4C957F2D)) >> U64(63) == 0
        next_left = np.append(left[1:], True)
        takes = left & ~next_left & ~edge[1:]
        taken = np.concatenate([[False], takes[:-1]])
        fixed_low, fixed_high = np.append(low, 0), np.append(high, 0)
        place = np.arange(len(name))
        low = np.where(~left & ~taken, np.where(edge[:-1], -NEVER, fixed_low[place - 1]), low)
        high = np.where(left, np.where(edge[1:], NEVER, fixed_high[place + 1]), high)
        two = np.flatnonzero(takes)
        symbol = name.copy()
        symbol[two] = mix(mix(name[two]) * U64(3) + name[two + 1])
        rest = np.flatnonzero(~taken)
        name, text, low, high = symbol[rest], text[rest], low[rest], high[rest]
    return name, text, low, high


class Parsed:
    """The words of a block of whole texts, and what the passes need of them."""

    def __init__(self, column: pa.Array) -> None:
        self.data, self.offsets = text_bytes(column)
        self.starts, self.ends, self.bounds = find_words(self.data, self.offsets, BY_SPACE)
        self.n_words = np.diff(self.bounds)

    def digests(self, kept: np.ndarray | None = None) -> list[bytes]:
        """sha256 of the words of each text, or of those that are kept, joined by one blank."""
        data, offsets = self.text(kept)
        return [hashlib.sha256(data[a:b]).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]

    def text(self, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        if kept is None:
            return joined(self.data, self.offsets, self.starts, self.ends, self.bounds)
        bounds = np.concatenate([[0], np.cumsum(kept)])[self.bounds]
        return joined(self.data, self.offsets, self.starts[kept], self.ends[kept], bounds)

    def anchors(self, window: int, one_in: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(name, text, low, high) of the symbols a window can fix whose names serve as anchors, in their order."""
        words = hash_words(self.data, self.starts, self.ends)
        name, text, low, high = recompress(words, self.bounds, rounds_for(window))
        use = np.flatnonzero((high - low <= window) & (mix(name ^ U64(0xA0761D6478BD642F)) % U64(one_in) == 0))
        return name[use], text[use], low[use], high[use]

    def open_windows(self, window: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """First words of the windows that cover none of the contexts."""
        n = len(self.starts)
        change = np.zeros(n + 1, dtype=np.int64)
        first = np.maximum(high - window, 0)
        np.add.at(change, first, 1)
        np.add.at(change, low + 1, -1)
        free = np.cumsum(change[:-1]) == 0
        # windows that leave their text
        past = np.zeros(n + 1, dtype=np.int64)
        np.add.at(past, np.maximum(self.bounds[1:] - window + 1, self.bounds[:-1]), 1)
        np.add.at(past, self.bounds[1:], -1)
        return np.flatnonzero(free & (np.cumsum(past[:-1]) == 0))

    def fingerprints(self, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of the words of each window."""
        out = []
        for lane, base in enumerate(BASES):
            words = hash_words(self.data, self.starts, self.ends, lane)
            forward = np.cumprod(np.concatenate([np.ones(1, U64), np.full(len(words), base, U64)]), dtype=U64)
            backward = np.cumprod(
                np.concatenate([np.ones(1, U64), np.full(len(words), pow(base, -1, 1 << 64), U64)]), dtype=U64
            )
            sums = np.concatenate([np.zeros(1, U64), np.cumsum(words * forward[:-1], dtype=U64)])
            out.append(mix((sums[at + window] - sums[at]) * backward[at]))
        return out[0], out[1]


# ------------------------------------------------- arrays of many owners in rows
SHIPPED = "bucket long, owners binary, counts binary, names binary, places binary"
SETTLED = "id long, key binary, places binary"


def _binary(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Binary values: the bytes of ``values`` cut before each of ``cuts`` (the last is the end)."""
    raw = np.ascontiguousarray(values)
    offsets = (cuts * raw.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where equal neighbours begin, and the end."""
    n = len(columns[0])
    change = np.zeros(max(0, n - 1), dtype=bool)
    for c in columns:
        change |= c[1:] != c[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1, [n]]) if n else np.zeros(1, np.int64)


OWNER = np.dtype([("id", "<i8"), ("key", "V16")])


class Shipment:
    """Entries (name, owner, place) of a map block: what the block can settle itself, and rows for the buckets."""

    def __init__(self, buckets: int, settle: Callable) -> None:
        self.buckets, self.settle = buckets, settle
        self.clear()

    def clear(self) -> None:
        self.names: list[np.ndarray] = []
        self.owner: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.owners: list[np.ndarray] = []
        self.n = self.n_owners = 0

    def add(self, names: np.ndarray, owner: np.ndarray, places: np.ndarray, owners: np.ndarray) -> None:
        """``names`` has one column or two of 64 bits; ``owner`` counts into ``owners``."""
        self.names.append(names)
        self.owner.append(owner + self.n_owners)
        self.places.append(places)
        self.owners.append(owners)
        self.n += len(names)
        self.n_owners += len(owners)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        names, owner, places = np.concatenate(self.names), np.concatenate(self.owner), np.concatenate(self.places)
        owners = np.concatenate(self.owners)
        self.clear()
        order = np.lexsort((owner, *names.T[::-1]))
        names, owner, places = names[order], owner[order], places[order]
        done, ship, mark = self.settle(names, owners, owner)
        yield from self.packed(names[ship], owner[ship], np.where(mark, -1, places)[ship], owners)
        # settled entries pass through any bucket
        yield from self.packed(None, owner[done], places[done], owners)

    def packed(self, names: np.ndarray | None, owner: np.ndarray, places: np.ndarray, owners: np.ndarray) -> Iterator[pa.RecordBatch]:
        bucket = mix(owner.astype(U64) if names is None else names[:, 0]) % U64(self.buckets)
        batch = _packed(bucket.astype(np.int64), names, owner, places, owners)
        for start in range(0, batch.num_rows, 1000):
            yield batch.slice(start, 1000)


def _packed(bucket: np.ndarray, names: np.ndarray | None, owner: np.ndarray, places: np.ndarray, owners: np.ndarray) -> pa.RecordBatch:
    """One row per bucket, see ``SHIPPED``; ``counts`` says how many entries each of the row's owners has."""
    order = np.lexsort((places, owner, bucket))
    bucket, owner, places = bucket[order], owner[order], places[order]
    by_bucket, by_owner = _runs(bucket), _runs(bucket, owner)
    owner_cuts = np.searchsorted(by_owner, by_bucket)
    columns = [
        pa.array(bucket[by_bucket[:-1]]),
        _binary(owners[owner[by_owner[:-1]]], owner_cuts),
        _binary(np.diff(by_owner).astype(np.int32), owner_cuts),
        pa.nulls(len(by_bucket) - 1, pa.binary()) if names is None else _binary(names[order].view(f"V{8 * names.shape[1]}").ravel(), by_bucket),
        _binary(places.astype(np.int32), by_bucket),
    ]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "owners", "counts", "names", "places"])


def _unpacked(table: pa.Table, wide: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(names, owner, places, owners) of rows of one kind."""
    read = lambda column, kind: np.frombuffer(b"".join(x or b"" for x in table.column(column).to_pylist()), dtype=kind)
    owners, counts = read("owners", OWNER), read("counts", np.int32)
    names = read("names", U64).reshape(-1, 2 if wide else 1) if "names" in table.column_names else None
    return names, np.repeat(np.arange(len(owners)), counts), read("places", np.int32), owners


def _owner_keys(owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    halves = np.ascontiguousarray(owners["key"]).view(U64).reshape(-1, 2)
    return halves[:, 0], halves[:, 1]


def _settled(owner: np.ndarray, places: np.ndarray, owners: np.ndarray) -> pa.Table:
    """One row per owner with all its places."""
    high, low = _owner_keys(owners)
    order = np.lexsort((low, high, owners["id"]))
    cuts = _runs(owners["id"][order], high[order], low[order])
    number = np.empty(len(owners), dtype=np.int64)
    number[order] = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    who = owners[order[cuts[:-1]]]
    owner = number[owner]
    order = np.argsort(owner, kind="stable")
    places = places[order].astype(np.int32)
    ends = np.searchsorted(owner[order], np.arange(len(who) + 1))
    return pa.table({"id": who["id"].copy(), "key": _binary(who["key"].copy(), np.arange(len(who) + 1)), "places": _binary(places, ends)})


def _by_name(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal names begin, and the number of its run for each entry."""
    cuts = _runs(*names.T)
    return cuts[:-1], np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))


def _several(first: np.ndarray, values: list[np.ndarray]) -> np.ndarray:
    """Whether a run holds different values."""
    return np.any([np.minimum.reduceat(v, first) != np.maximum.reduceat(v, first) for v in values], axis=0)


def share_in_block(names: np.ndarray, owners: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of several classes are shared whatever else there is; one marked entry tells their bucket so."""
    first, run = _by_name(names)
    shared = _several(first, [half[owner] for half in _owner_keys(owners)])[run]
    mark = np.zeros(len(owner), dtype=bool)
    mark[first] = shared[first]
    return np.flatnonzero(shared), np.flatnonzero(~shared | mark), mark


def share_in_bucket(names: np.ndarray, owners: np.ndarray, owner: np.ndarray, places: np.ndarray) -> np.ndarray:
    first, run = _by_name(names)
    told = np.minimum.reduceat(places, first) < 0
    return (told | _several(first, [half[owner] for half in _owner_keys(owners)]))[run] & (places >= 0)


def cover_in_block(names: np.ndarray, owners: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that a smaller id of the block holds are covered; those of the smallest id go to the bucket."""
    first, run = _by_name(names)
    ids = owners["id"][owner]
    later = ids > np.minimum.reduceat(ids, first)[run]
    return np.flatnonzero(later), np.flatnonzero(~later), np.zeros(len(owner), dtype=bool)


def cover_in_bucket(names: np.ndarray, owners: np.ndarray, owner: np.ndarray, places: np.ndarray) -> np.ndarray:
    first, run = _by_name(names)
    ids = owners["id"][owner]
    return ids > np.minimum.reduceat(ids, first)[run]


def _group(shipped: DataFrame, wide: bool, buckets: int, test: Callable) -> DataFrame:
    """(id, key, places), one row per owner: the entries that their block or their bucket tells apart.

    Both groupings are by hash buckets of bounded size, the first of names and the second of owners.
    """

    def judge(table: pa.Table) -> pa.Table:
        out = []
        passed = pc.is_null(table.column("names"))
        for mine, settled in ((table.filter(pc.invert(passed)), False), (table.filter(passed), True)):
            names, owner, places, owners = _unpacked(mine, wide)
            if not settled and len(owner):
                order = np.lexsort(names.T[::-1])
                chosen = order[test(names[order], owners, owner[order], places[order])]
                owner, places = owner[chosen], places[chosen]
            high, _ = _owner_keys(owners)
            bucket = (mix(high + owners["id"].astype(U64)) % U64(buckets)).astype(np.int64)
            out.append(pa.Table.from_batches([_packed(bucket[owner], None, owner, places, owners)]))
        return pa.concat_tables(out).select(["bucket", "owners", "counts", "places"])

    def merge(table: pa.Table) -> pa.Table:
        _, owner, places, owners = _unpacked(table, wide)
        return _settled(owner, places, owners)

    found = shipped.groupBy("bucket").applyInArrow(judge, "bucket long, owners binary, counts binary, places binary")
    return found.groupBy("bucket").applyInArrow(merge, SETTLED)


def _merged(places: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All places of a column of binary values, and the row of each."""
    rows = [x or b"" for x in places.to_pylist()]
    return np.frombuffer(b"".join(rows), dtype=np.int32), np.repeat(np.arange(len(rows)), [len(r) // 4 for r in rows])


# ------------------------------------------------------------------ passes
def _own(name: str = "doc_id") -> Column:
    return F.coalesce(F.col(name), F.lit(LAST))


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, id, n_words, digest) of every row; ``id`` is never null."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text", BLOCK_BYTES):
            texts = Parsed(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("id"), pa.array(texts.n_words), pa.array(texts.digests(), pa.binary())],
                ["doc_id", "id", "n_words", "digest"],
            )

    rows = pick(docs, doc_id="long", text="string").withColumn("id", _own())
    return rows.mapInArrow(measure, "doc_id long, id long, n_words long, digest binary")


def _owners(batch: pa.RecordBatch, digests: list[bytes]) -> np.ndarray:
    out = np.empty(batch.num_rows, dtype=OWNER)
    out["id"] = batch.column("id").to_numpy()
    out["key"] = np.frombuffer(b"".join(d[:16] for d in digests), dtype="V16")
    return out


def shared_anchors(docs: DataFrame, window: int, one_in: int, buckets: int) -> DataFrame:
    """(key, places): which anchors of a class (counted in their order) another class has, too."""

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Shipment(buckets, share_in_block)
        for batch in blocks(batches, "text", BLOCK_BYTES):
            texts = Parsed(batch.column("text"))
            name, text, _, _ = texts.anchors(window, one_in)
            before = np.searchsorted(text, np.arange(batch.num_rows))
            owners = _owners(batch, texts.digests())
            owners["id"] = 0  # copies are one owner
            held.add(name[:, None], text, np.arange(len(name)) - before[text], owners)
            if held.n >= FLUSH:
                yield from held.rows()
        yield from held.rows()

    shipped = pick(docs, doc_id="long", text="string").withColumn("id", _own()).mapInArrow(ship, SHIPPED)
    return _group(shipped, False, buckets, share_in_bucket).select("key", "places")


def covered_windows(docs: DataFrame, classes: DataFrame, anchors: DataFrame, window: int, one_in: int, buckets: int) -> DataFrame:
    """(id, key, places): the first words of windows that a smaller id holds, for the text that stands for its class."""

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Shipment(buckets, cover_in_block)
        for batch in blocks(batches, "text", BLOCK_BYTES):
            texts = Parsed(batch.column("text"))
            digests = texts.digests()
            name, text, low, high = texts.anchors(window, one_in)
            before = np.searchsorted(text, np.arange(batch.num_rows))
            known, row = _merged(batch.column("places"))
            alone = np.ones(len(name), dtype=bool)
            mine = np.array([d[:16] == k for d, k in zip(digests, batch.column("key").to_pylist(), strict=True)], dtype=bool)
            alone[(before[row] + known)[mine[row]]] = False
            at = texts.open_windows(window, low[alone], high[alone])
            text_of = np.searchsorted(texts.bounds, at, side="right") - 1
            at, text_of = at[mine[text_of]], text_of[mine[text_of]]
            held.add(np.stack(texts.fingerprints(at, window), axis=1), text_of, at - texts.bounds[text_of], _owners(batch, digests))
            if held.n >= FLUSH:
                yield from held.rows()
        yield from held.rows()

    told = classes.join(anchors, "key", "left").select("id", "key", "places")
    texts = pick(docs, doc_id="long", text="string").select(_own().alias("id"), "text")
    return _group(texts.join(told, "id").mapInArrow(ship, SHIPPED), True, buckets, cover_in_bucket)


def without_covered(docs: DataFrame, covered: DataFrame, window: int, with_text: bool) -> DataFrame:
    """(id, digest, n_removed, kept_sha256[, kept_text]) of the texts that lose words under their own windows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text", BLOCK_BYTES):
            texts = Parsed(batch.column("text"))
            digests = texts.digests()
            mine = np.array([d[:16] == k for d, k in zip(digests, batch.column("key").to_pylist(), strict=True)], dtype=bool)
            places, row = _merged(batch.column("places"))
            at = (texts.bounds[row] + places)[mine[row]]
            change = np.zeros(len(texts.starts) + 1, dtype=np.int64)
            np.add.at(change, at, 1)
            np.add.at(change, at + window, -1)
            kept = np.cumsum(change[:-1]) == 0
            removed = texts.n_words - np.diff(np.concatenate([[0], np.cumsum(kept)])[texts.bounds])
            columns = [batch.column("id"), pa.array(digests, pa.binary()), pa.array(removed), pa.array([d.hex() for d in texts.digests(kept)])]
            names = ["id", "digest", "n_removed", "kept_sha256"]
            if with_text:
                data, offsets = texts.text(kept)
                columns.append(_binary(data, offsets).cast(pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(mine))

    rows = pick(docs, doc_id="long", text="string").select(_own().alias("id"), "text").join(covered, "id")
    schema = "id long, digest binary, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return rows.mapInArrow(cut, schema).dropDuplicates(["id", "digest"])


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, one_in: int = ONE_IN, bucket_words: int = BUCKET_WORDS, with_text: bool = True
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept_text]) for every row of ``docs``.

    Every word goes that lies in a window of ``window`` words which also starts in a document with a smaller ``doc_id``.
    ``kept_text`` is what is left, joined by one blank.  ``one_in``: one name in so many serves as an anchor.
    """
    seen = stored(measured(docs), "repeat-digests")
    total = seen.agg(F.sum("n_words")).first()[0] or 0
    buckets = lambda entries: max(1, -(-entries // bucket_words))
    classes = stored(
        seen.where(F.col("n_words") >= window).groupBy("digest").agg(F.min("id").alias("id")).select("id", "digest", F.substring("digest", 1, 16).alias("key")),
        "repeat-classes",
    )
    anchors = shared_anchors(docs, window, one_in, buckets(total // (3 * one_in)))
    covered = stored(covered_windows(docs, classes.select("id", "key"), anchors, window, one_in, buckets(total)), "repeat-windows")
    cut = without_covered(docs, covered, window, with_text)
    placed = seen.join(classes.select("digest", F.col("id").alias("first")), "digest", "left").join(cut, ["id", "digest"], "left")
    copy = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    out = placed.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.lit(EMPTY)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest")))).alias("kept_sha256"),
        *(["digest", "id", F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text")] if with_text else []),
    )
    if not with_text:
        return out
    # texts that lose nothing are read again, in their own words
    whole = _whole_texts(docs)
    kept = out.withColumnRenamed("kept_text", "cut_text").join(whole, ["id", "digest"], "left")
    return kept.select("doc_id", "n_words", "n_removed", "kept_sha256", F.coalesce("cut_text", "kept_text").alias("kept_text"))


def _whole_texts(docs: DataFrame) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text", BLOCK_BYTES):
            texts = Parsed(batch.column("text"))
            data, offsets = texts.text()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(texts.digests(), pa.binary()), _binary(data, offsets).cast(pa.string())],
                ["id", "digest", "kept_text"],
            )

    rows = pick(docs, doc_id="long", text="string").select(_own().alias("id"), "text")
    return rows.mapInArrow(read, "id long, digest binary, kept_text string").dropDuplicates(["id", "digest"])


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT k, doc_id, unnest(range(1, len(w) - {WINDOW} + 2)) AS p, w FROM d WHERE len(w) >= {WINDOW}),
f AS (SELECT k, doc_id, p, sha256(array_to_string(list_slice(w, p, p + {WINDOW} - 1), ' ')) AS h FROM s),
m AS (SELECT h, min(doc_id) AS first FROM f GROUP BY h),
c AS (SELECT k, p FROM f JOIN m USING (h) WHERE f.doc_id > m.first),
t AS (SELECT k, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d),
x AS (SELECT t.k, t.p, t.word, max(CASE WHEN c.p IS NULL THEN 0 ELSE 1 END)
        OVER (PARTITION BY t.k ORDER BY t.p ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) AS gone
      FROM t LEFT JOIN c ON c.k = t.k AND c.p = t.p),
r AS (SELECT k, sum(gone) AS n, string_agg(word, ' ' ORDER BY p) FILTER (WHERE gone = 0) AS kept FROM x GROUP BY k)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(r.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(r.kept, '')) AS kept_sha256
FROM d LEFT JOIN r ON r.k = d.k
"""
