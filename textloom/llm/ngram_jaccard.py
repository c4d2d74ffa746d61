"""N-gram Jaccard self-join of documents: prefix filters under several global token orders.

A document is the set of its word shingles.  Two documents link if their Jaccard similarity
reaches a threshold.  Under any order of all tokens, linked documents share a token among the
first ``n - ceil(threshold * n) + 1`` tokens of each; so a pair that has none in common under
one of several orders needs no check.

* Each order puts often-seen shingles last (classes of a table of the most frequent
  shingles, counted over all documents) and sorts by an order-specific hash within a class.  The
  table only shapes the orders, which are valid whatever it holds, so its size is fixed.
* Documents with equal sets are one class; only classes are joined.
* The first order's prefix tokens form buckets.  Within a bucket, pairs are left if their sizes fit and the parity
  bitmaps of their sets (a lower bound of the difference) allow a link; a spanning forest of them is returned.
  What these connect is a group: every pair the filters leave is inside one group.
* A group's members meet in blocks of about ``block`` classes; a block pair intersects the filters of the other
  orders, then verifies the remaining pairs exactly from the whole sets, and returns a spanning forest of the
  links found, not the pairs.  A group of any size is thus split over many tasks.
* Components follow by star contraction of these forests.

Shingles are 64-bit hashes of the words; sets, sizes and intersections are those of the hashes.  The hash of a word mixes its
bytes eight at a time, so no structure of words makes two of them meet: among n shingles a given pair meets with a
probability of 2^-64, and to link two texts by mistake a tenth of their shingles would have to.

Defined cases: a null or wordless text has an empty set and links to nothing; with fewer words than the
shingle length the whole sequence is one shingle; rows with equal ``doc_id`` are one
document with the links of all its rows; a row with a null ``doc_id`` links to nothing and has a null
component; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import blocks, by_place, pick, stored
from textloom.llm.components import components
from textloom.llm.words import BY_SPACE, FOLD, U64, find_words, hash_words, text_bytes

ORDERS = 3
FREQUENT = 1 << 16
WINDOW_TOKENS = 2_000_000
BLOCK = 1024
BROADCAST_ROWS = 1_000_000

MIXERS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)


def mix(x: np.ndarray, multiplier: int = MIXERS[0]) -> np.ndarray:
    x = (x ^ (x >> U64(31))) * U64(multiplier)
    return x ^ (x >> U64(29))


def shingles(texts: list[str | None], words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; the work is done on all texts at once."""
    data, offsets = text_bytes(pa.array(texts, pa.large_string()))
    data = FOLD[data]
    starts, ends, first = find_words(data, offsets, BY_SPACE)
    word = hash_words(data, starts, ends)
    run = word.copy()
    for k in range(1, min(words, len(word))):
        run = mix(run[:-1] * U64(MIXERS[1]) + word[k:], MIXERS[2])
    out = []
    for i in range(len(texts)):
        low, high = int(first[i]), int(first[i + 1])
        if high - low >= words:
            out.append(np.unique(run[low : high - words + 1]))
        elif high > low:
            out.append(np.array([xxhash.xxh64_intdigest(word[low:high].tobytes())], dtype=U64))
        else:
            out.append(np.empty(0, U64))
    return out


# ------------------------------------------------------------ token orders
class Orders:
    """The global orders, from the table of frequent shingles (sorted hashes and their class)."""

    def __init__(self, frequent: np.ndarray, classes: np.ndarray) -> None:
        self.frequent, self.classes = frequent, classes
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(frequent >> U64(44)).astype(np.int64)] = True

    def keys(self, tokens: np.ndarray, order: int) -> np.ndarray:
        key = mix(tokens + U64(order + 1), MIXERS[order % 3]) >> U64(6)
        near = np.flatnonzero(self.maybe[(tokens >> U64(44)).astype(np.int64)])
        if len(near):
            at = np.minimum(np.searchsorted(self.frequent, tokens[near]), len(self.frequent) - 1)
            hit = self.frequent[at] == tokens[near]
            key[near[hit]] |= self.classes[at[hit]].astype(U64) << U64(58)
        return key

    def prefix(self, tokens: np.ndarray, order: int, percent: int) -> np.ndarray:
        """The first tokens of a set; ties of a key fall to the smaller hash in every set."""
        n = len(tokens)
        length = n - -(-percent * n // 100) + 1
        if length >= n:
            return tokens
        key = self.keys(tokens, order)
        edge = np.partition(key, length - 1)[length - 1]
        chosen = np.flatnonzero(key <= edge)
        if len(chosen) > length:
            chosen = chosen[np.lexsort((tokens[chosen], key[chosen]))][:length]
        return tokens[chosen]


def frequent_shingles(docs: DataFrame, words: int) -> Orders:
    """The ``FREQUENT`` most frequent shingles, from document counts over all texts in windows of bounded memory."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        total = 0

        def window() -> pa.RecordBatch:
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(tokens[often].view(np.int64)), pa.array(counts[often].astype(np.int64))], ["token", "n"]
            )

        for batch in blocks(batches, "text"):
            for tokens in shingles(batch.column("text").to_pylist(), words):
                held.append(tokens)
                total += len(tokens)
            if total >= WINDOW_TOKENS:
                yield window()
                held, total = [], 0
        if total:
            yield window()

    counted = pick(docs, text="string").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "token").limit(FREQUENT).toPandas()
    tokens = top["token"].to_numpy(dtype=np.int64).view(U64)
    order = np.argsort(tokens)
    classes = np.minimum(63, 1 + np.log2(np.maximum(1, top["n"].to_numpy(dtype=float)))).astype(np.int64)
    return Orders(tokens[order], classes[order])


# ------------------------------------------------------------------- steps
def signatures(docs: DataFrame, orders: Orders, words: int, percent: int) -> DataFrame:
    """(doc_id, n, fp, prefix, bits): set size, fingerprint, prefix under the first order and parity bitmap."""
    shipped = docs.sparkSession.sparkContext.broadcast(orders)  # FREQUENT entries

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            sets = shingles(batch.column("text").to_pylist(), words)
            prefixes = [shipped.value.prefix(s, 0, percent).view(np.int64) if len(s) else s.view(np.int64) for s in sets]
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(prefixes))),
                    pa.array([parity_bits(s) for s in sets], pa.binary()),
                ],
                ["doc_id", "n", "fp", "prefix", "bits"],
            )

    return pick(docs, doc_id="long", text="string").mapInArrow(sign, "doc_id long, n long, fp binary, prefix array<long>, bits binary")


def parity_bits(tokens: np.ndarray) -> bytes:
    """A bitmap where each token toggles one bit; its size goes with the set's, so that long sets differ visibly.

    Two bitmaps of one size differ in at most as many bits as the sets do in tokens; a larger one
    folds to a smaller size by xor of its halves.
    """
    size = max(1024, 1 << max(0, len(tokens) // 2).bit_length())
    odd = np.bincount((mix(tokens, MIXERS[2]) & U64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _fold(bits: bytes, size: int) -> np.ndarray:
    words = np.frombuffer(bits, dtype=U64)
    while len(words) * 8 > size:
        words = words[: len(words) // 2] ^ words[len(words) // 2 :]
    return words


def bucket_forest(sizes: np.ndarray, bits: list[bytes], percent: int) -> list[tuple[int, int]]:
    """A spanning forest (root, member) of the pairs of a bucket whose sizes and bitmaps allow a link."""
    size = min(map(len, bits))
    folded = np.stack([_fold(b, size) for b in bits])
    m, left, forest = len(sizes), np.ones(len(sizes), dtype=bool), []
    # sets with s tokens in all and similarity t differ in at most s * (1 - t) / (1 + t) tokens
    for root in range(m):
        if not left[root]:
            continue
        left[root] = False
        frontier = [root]
        while frontier:
            at = frontier.pop()
            others = np.flatnonzero(left)
            if not len(others):
                break
            small, large = np.minimum(sizes[at], sizes[others]), np.maximum(sizes[at], sizes[others])
            others = others[100 * small >= percent * large]
            apart = np.bitwise_count(folded[others] ^ folded[at]).sum(axis=1, dtype=np.int64)
            near = others[apart * (100 + percent) <= (sizes[at] + sizes[others]) * (100 - percent)]
            left[near] = False
            forest += [(root, int(i)) for i in near]
            frontier += near.tolist()
    return forest


def candidate_links(classes: DataFrame, percent: int, block: int) -> DataFrame:
    """(a, b): links between classes that share a prefix token of the first order and pass size and bitmap.

    Only a spanning forest of each bucket is returned: the pairs of a bucket are never formed.  A bucket is cut
    where sizes stop fitting; one of more than ``block`` classes is dealt to blocks, of which each two meet.
    """
    tokens = classes.select(F.explode("prefix").alias("token"), "doc_id", "n")
    by_size = Window.partitionBy("token").orderBy("n", "doc_id")
    fits = lambda small, large: F.coalesce(100 * small >= percent * large, F.lit(False))
    joins = tokens.select(
        "*", fits(F.lag("n").over(by_size), F.col("n")).alias("before"), fits(F.col("n"), F.lead("n").over(by_size)).alias("after")
    )
    runs = joins.where(F.col("before") | F.col("after")).withColumn(
        "run", F.sum(F.when(F.col("before"), 0).otherwise(1)).over(by_size.rowsBetween(Window.unboundedPreceding, 0))
    )
    parts = F.ceil(F.count("*").over(Window.partitionBy("token", "run")) / block).cast("int")
    dealt = _meeting(runs.withColumn("parts", parts).withColumn("mine", F.pmod(F.xxhash64("doc_id"), "parts").cast("int")))
    rows = dealt.select("token", "run", "i", "j", "doc_id", "n").join(classes.select("doc_id", "bits"), "doc_id")
    met = rows.repartition("token", "run", "i", "j").sortWithinPartitions("token", "run", "i", "j")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, names, sizes, bits, found = None, [], [], [], set()

        def flush() -> None:
            if len(names) > 1:
                found.update((names[a], names[b]) for a, b in bucket_forest(np.array(sizes, dtype=np.int64), bits, percent))

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("token", "run", "i", "j", "doc_id", "n", "bits"))
            for token, run, i, j, name, n, bitmap in zip(*columns, strict=True):
                if (token, run, i, j) != here:
                    flush()
                    here, names, sizes, bits = (token, run, i, j), [], [], []
                names.append(name)
                sizes.append(n)
                bits.append(bitmap)
            if len(found) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])
                found.clear()
        flush()
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])

    return met.mapInArrow(link, "a long, b long").distinct()


def _meeting(rows: DataFrame) -> DataFrame:
    """Rows of block ``mine`` of ``parts``, once for each block (i, j) they meet, their own included."""
    mine = F.col("mine")
    meets = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda other: F.struct(F.least(other, mine).alias("i"), F.greatest(other, mine).alias("j")),
    )
    return rows.select("*", F.explode(meets).alias("pair")).select(*rows.columns, "pair.i", "pair.j")


def member_sets(docs: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """(key, group, i, j, doc_id, fp, tokens) of ``members(doc_id, fp, group, mine, parts)``, from their whole texts.

    A block of a group meets every block of the group, itself included, once.  The members are broadcast only
    if their counted number is within ``BROADCAST_ROWS``.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            found = [s.tobytes() for s in shingles(batch.column("text").to_pylist(), words)]
            same = [xxhash.xxh128_digest(s) == f for s, f in zip(found, batch.column("fp").to_pylist(), strict=True)]
            out = pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "fp", "group", "mine", "parts")), pa.array(found, pa.binary())],
                ["doc_id", "fp", "group", "mine", "parts", "tokens"],
            )
            yield out.filter(pa.array(same))

    if members.count() <= BROADCAST_ROWS:
        members = F.broadcast(members)
    texts = pick(docs, doc_id="long", text="string").join(members, "doc_id")
    made = texts.select("doc_id", "fp", "group", "mine", "parts", "text").mapInArrow(
        sets, "doc_id long, fp binary, group long, mine int, parts int, tokens binary"
    )
    return _meeting(made).select("group", "i", "j", "doc_id", "fp", "tokens")


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all pairs, exact, from 0/1 matrices over slices of the shared tokens."""
    m = len(sets)
    rows = np.repeat(np.arange(m), [len(s) for s in sets])
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(counts > 1) - 1
    keep = counts[column] > 1
    rows, column = rows[keep], number[column[keep]]
    width = int(column.max()) + 1 if len(column) else 0
    out = np.zeros((m, m), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    for low in range(0, width, 4096):
        a, b = np.searchsorted(column, [low, low + 4096])
        x = np.zeros((m, 4096), dtype=np.float32)
        x[rows[a:b], column[a:b] - low] = 1
        out += x @ x.T
    return out


def links_of(sets: list[np.ndarray], orders: Orders, percent: int) -> list[tuple[int, int]]:
    """A spanning forest (root, member) of the links among ``sets``; all pairs are filtered, the rest verified."""
    m = len(sets)
    if m < 2:
        return []
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    able = 100 * np.minimum(sizes[:, None], sizes[None, :]) >= percent * np.maximum(sizes[:, None], sizes[None, :])
    for order in range(1, ORDERS):
        able &= _shared([orders.prefix(s, order, percent) for s in sets]) > 0
    np.fill_diagonal(able, False)
    active = np.flatnonzero(able.any(axis=1))
    if len(active) < 2:
        return []
    able = able[np.ix_(active, active)]
    both = _shared([sets[i] for i in active]).astype(np.int64)
    n = sizes[active]
    linked = able & (100 * both >= percent * (n[:, None] + n[None, :] - both))
    left, forest = np.ones(len(active), dtype=bool), []
    for root in range(len(active)):
        if left[root]:
            left[root] = False
            frontier = np.array([root])
            while len(frontier):
                frontier = np.flatnonzero(linked[frontier].any(axis=0) & left)
                left[frontier] = False
                forest += [(int(active[root]), int(active[i])) for i in frontier]
    return forest


def group_links(sets: DataFrame, orders: Orders, percent: int) -> DataFrame:
    """(a, b) doc ids: a spanning forest of the links within each pair of blocks of a group."""
    shipped = sets.sparkSession.sparkContext.broadcast(orders)  # FREQUENT entries
    met = sets.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j", "fp")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, names, held, last, found = None, [], [], None, []

        def result() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])

        for batch in batches:
            place = list(zip(*(batch.column(c).to_pylist() for c in ("group", "i", "j")), strict=True))
            ids, fps, data = batch.column("doc_id").to_pylist(), batch.column("fp").to_pylist(), batch.column("tokens")
            for k, at in enumerate(place):
                if at != here:
                    found += [(names[a], names[b]) for a, b in links_of(held, shipped.value, percent)]
                    here, names, held, last = at, [], [], None
                if fps[k] != last:  # repeated rows of a document come one after another
                    last = fps[k]
                    names.append(ids[k])
                    held.append(np.frombuffer(data[k].as_py(), dtype=U64))
            if found:
                yield result()
                found = []
        found += [(names[a], names[b]) for a, b in links_of(held, shipped.value, percent)]
        if found:
            yield result()

    return met.mapInArrow(verify, "a long, b long")


def jaccard_components(docs: DataFrame, words: int = 3, percent: int = 90, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row: the component is the smallest ``doc_id`` linked to it.

    ``percent`` is the threshold in hundredths: linked if 100 * intersection >= percent * union.
    """
    orders = frequent_shingles(docs, words)
    signed = stored(signatures(docs, orders, words, percent), "jaccard-signatures")
    known = signed.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = stored(
        known.groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits")),
        "jaccard-classes",
    )
    name = classes.select("fp", "doc_id")
    # groups: what the first order's prefix filter, sizes and bitmaps connect
    groups = components(candidate_links(classes, percent, block)).select(F.col("node").alias("doc_id"), F.col("component").alias("group"))
    sizes = groups.groupBy("group").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    members = name.join(groups, "doc_id").join(sizes, "group")
    members = members.withColumn("mine", F.pmod(F.xxhash64("fp"), "parts").cast("int"))
    members = stored(members.select("doc_id", "fp", "group", "mine", "parts"), "jaccard-members")
    links = group_links(member_sets(docs, members, words), orders, percent)
    # a document with several texts is one node: its classes link
    of_row = known.select("doc_id", "fp").distinct().join(name.withColumnRenamed("doc_id", "x"), "fp")
    several = of_row.groupBy("doc_id").agg(F.min("x").alias("low"), F.max("x").alias("high")).where("low < high")
    own = of_row.join(several, "doc_id").select(F.col("x").alias("a"), F.col("low").alias("b"))
    found = components(links.union(own))
    placed = name.join(found, name["doc_id"] == found["node"], "left").select(
        "fp", F.coalesce("component", name["doc_id"]).alias("component_id")
    )
    return signed.select("doc_id", "n", "fp").join(placed, "fp", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def keep_one_each(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest ``doc_id``; columns stay.

    Repeated rows of that id leave one row; rows with a null ``doc_id`` all stay.
    """
    placed, name_of = by_place(docs)
    own = name_of("doc_id")
    found = jaccard_components(docs, words, percent).where("component_id = doc_id").select(F.col("doc_id").alias(own)).distinct()
    kept = placed.join(found, own, "left_semi").dropDuplicates([own])
    return kept.unionByName(placed.where(F.col(own).isNull())).toDF(*docs.columns)


def oracle(words: int, percent: int) -> str:
    """SQL counterpart over the words themselves: classes of equal sets, one prefix filter (rarest shingles first), links, reach."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
i AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {words - 1}, 1) + 1)) AS p FROM d WHERE len(w) > 0),
g AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, p, p + {words - 1}), ' ') AS g FROM i),
s AS (SELECT doc_id, list(g ORDER BY g) AS t FROM g GROUP BY doc_id),
k AS (SELECT t, min(doc_id) AS c, len(t) AS n FROM s GROUP BY t),
f AS (SELECT c, n, unnest(t) AS g FROM k),
o AS (SELECT g, count(*) AS df FROM f GROUP BY g),
r AS (SELECT c, n, g, row_number() OVER (PARTITION BY c ORDER BY df, g) AS p FROM f JOIN o USING (g)),
x AS (SELECT * FROM r WHERE p <= n - ({percent} * n + 99) // 100 + 1),
e AS (SELECT DISTINCT a.c AS a, b.c AS b FROM x a JOIN x b ON a.g = b.g AND a.c < b.c
  AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)),
v AS (SELECT e.a, e.b FROM e JOIN f p ON p.c = e.a JOIN f q ON q.c = e.b AND q.g = p.g
  GROUP BY e.a, e.b, p.n, q.n HAVING 100 * count(*) >= {percent} * (p.n + q.n - count(*))),
l AS (SELECT a, b FROM v UNION ALL SELECT b, a FROM v),
z AS (SELECT a AS c, b AS seen FROM l UNION SELECT z.c, l.b FROM z JOIN l ON l.a = z.seen),
m AS (SELECT c, min(least(c, seen)) AS least FROM z GROUP BY c)
SELECT d.doc_id, CAST(coalesce(k.n, 0) AS BIGINT) AS n_shingles, coalesce(m.least, k.c, d.doc_id) AS component_id
FROM d LEFT JOIN s ON s.doc_id = d.doc_id LEFT JOIN k ON k.t = s.t LEFT JOIN m ON m.c = k.c
"""
