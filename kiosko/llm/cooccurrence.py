"""Problem 5: items that appear together, by a blocked Gram matrix.

Baskets become sparse binary rows over numbered items.  A block of records is parted by blocks of items into sparse
matrices X_I (rows by record).  For each pair of item blocks I <= J the transpose-product X_I' X_J is formed by itself,
as sorted keys with counts; the products of a tile are summed over the task's record blocks, and the tasks' sums are
added up by pair.  The measures compare the counts with those expected from the marginals.

Only pairs of items that are frequent enough by themselves can be frequent, so items below the support are left out
before anything is multiplied.  Items number at most (mean basket size) * N / support; for a support of N / 2000 that
is 2000 times the mean basket, whatever N is.  The ``BROADCAST_ROWS`` most frequent items are numbered by a broadcast; if
there are more, the baskets' other entries are numbered by a join, in which no item is hot, for each has at most
1 / BROADCAST_ROWS of all entries.

Defined results: null and empty baskets count as baskets only if the caller passes them; items are distinct within a
basket, null items are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiosko.llm.consistent import articles, consistent_titles
from kiosko.plans.common import BROADCAST_ROWS, hinted, written

#: Rows of a record block, blocks of items, products expanded at a time, partial sums kept by a task.
RECORDS, BLOCKS, PRODUCTS, HELD = 1 << 15, 16, 1 << 21, 1 << 21


def words(title: Column, least: int = 4) -> Column:
    """The distinct runs of at least ``least`` letters of a text, in lower case."""
    return F.array_distinct(F.filter(F.regexp_extract_all(F.lower(title), F.lit(r"(\p{L}+)"), F.lit(1)), lambda w: F.length(w) >= least))


class Block:
    """X_I of a block of records: ``items`` row by row, the places of each row from ``indptr``, and the row of each."""

    def __init__(self, row: np.ndarray, items: np.ndarray, rows: int):
        self.row, self.items = row, items
        self.indptr = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))])


def product(left: Block, right: Block) -> tuple[np.ndarray, np.ndarray]:
    """X_I' X_J as (keys a << 32 | b, counts), keys sorted; above the diagonal if both are the same block.

    Each entry of X_I meets the entries of its row in X_J; expansion is vectorised over the entries and bounded to about
    ``PRODUCTS`` at a time, however long a row is.
    """
    first, last = right.indptr[left.row], right.indptr[left.row + 1]
    if left is right:
        first = np.arange(len(left.items)) + 1  # items are sorted within a row
    n = last - first
    total = np.cumsum(n)
    out = []
    at = 0
    while at < len(n):
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + PRODUCTS, side="right")))
        k = n[at:to]
        i = np.repeat(np.arange(at, to), k)
        j = first[i] + np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
        out.append(np.unique(left.items[i] << 32 | right.items[j], return_counts=True))
        at = to
    return _added(out)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    k, at = np.unique(np.concatenate([x for x, _ in parts]), return_inverse=True)
    return k, np.bincount(at, weights=np.concatenate([y for _, y in parts]), minlength=len(k)).astype(np.int64)


class Gram:
    """A task's part of the Gram matrix, tile by tile."""

    def __init__(self, items: int):
        self.width = max(1, -(-items // BLOCKS))  # items of a block
        self.tiles: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        self.size = 0

    def add(self, row: np.ndarray, items: np.ndarray, rows: int) -> None:
        """A block of records: its entries (row, item), sorted by both."""
        block = items // self.width
        parts = {int(b): Block(row[block == b], items[block == b], rows) for b in np.unique(block)}
        for i, left in parts.items():
            for j, right in parts.items():
                if i <= j:
                    tile = product(left, right)
                    if len(tile[0]):
                        self.tiles.setdefault((i, j), []).append(tile)
                        self.size += len(tile[0])
        if self.size > HELD:
            self.tiles = {t: [_added(x)] for t, x in self.tiles.items()}
            self.size = sum(len(x[0][0]) for x in self.tiles.values())

    def taken(self) -> Iterator[pa.RecordBatch]:
        for x in self.tiles.values():
            k, c = _added(x)
            yield pa.RecordBatch.from_arrays([pa.array(k >> 32), pa.array(k & 0xFFFFFFFF), pa.array(c.astype(np.int64))], names=["a", "b", "n"])
        self.tiles, self.size = {}, 0


def _multiply(batches: Iterator[pa.RecordBatch], items: int) -> Iterator[pa.RecordBatch]:
    """Of rows of item numbers: the tiles of their Gram matrix, as (a, b, n), a < b."""
    gram = Gram(items)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    rows = 0

    def multiply() -> Iterator[pa.RecordBatch]:
        nonlocal held, rows
        row = np.repeat(np.arange(rows), np.concatenate([n for n, _ in held]))
        flat = np.concatenate([x for _, x in held])
        order = np.lexsort((flat, row))
        gram.add(row[order], flat[order], rows)
        held, rows = [], 0
        if gram.size > HELD // 2:
            yield from gram.taken()

    for batch in batches:
        column = batch.column(0)
        n = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        held.append((n, column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)))
        rows += len(n)
        if rows >= RECORDS:
            yield from multiply()
    if rows:
        yield from multiply()
    yield from gram.taken()


def _encoded(column: pa.ListArray, get) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """(row, number or -1) of each entry, the rows' lengths, and the entries."""
    flat = column.flatten().to_pylist()
    n = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(n)), n), np.fromiter((get(x, -1) for x in flat), np.int64, len(flat)), n, flat


def vocabulary(baskets: DataFrame, items: str, support: int) -> tuple[DataFrame, int]:
    """(item, count, i): the items in at least ``support`` baskets, numbered in their order, as a table; and their number."""
    single = baskets.select(F.explode(items).alias("item")).where("item is not null").groupBy("item").count().where(F.col("count") >= support)
    # numbers in order of the items, so that a < b holds for numbers as for items
    spread = single.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ranged = written(single.repartitionByRange(max(1, int(spread)), "item").sortWithinPartitions("item").withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()))
    sizes = ranged.groupBy("part").agg(F.count("*").alias("c"), F.min("at").alias("lo")).orderBy("part").collect()  # a row a partition
    start, total = {}, 0
    for r in sizes:
        start[r.part] = (total, r.lo)
        total += r.c
    if total >= 1 << 31:
        raise ValueError("more than 2**31 frequent items; raise the support")
    if not start:
        return ranged.select("item", "count", F.col("at").alias("i")), 0
    offset = F.create_map(*[x for p, (s, lo) in start.items() for x in (F.lit(p), F.lit(s - lo))])
    return written(ranged.select("item", "count", (F.col("at") + offset[F.col("part")]).alias("i"))), total


def pair_counts(baskets: DataFrame, items: str = "items", support: int = 1) -> DataFrame:
    """(termino_a, termino_b, n_a, n_b, n_ab): every pair of items, a < b by code point, in at least ``support``
    baskets, with the baskets of each and of both.  ``baskets`` has an array of distinct strings a row; it is scanned
    twice, so expensive ones should be a written table."""
    support = max(1, support)
    known, total = vocabulary(baskets, items, support)
    head = known.orderBy(F.desc("count"), "i").limit(BROADCAST_ROWS).select("item", "i").collect()  # bounded
    shared = baskets.sparkSession.sparkContext.broadcast({r.item: r.i for r in head})
    schema = "a bigint, b bigint, n bigint"
    filled = F.coalesce(F.col(items), F.array().cast("array<string>")).alias("x")
    if total <= BROADCAST_ROWS:

        def encode_and_multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            get = shared.value.get

            def numbered() -> Iterator[pa.RecordBatch]:
                for b in batches:
                    row, flat, n, _ = _encoded(b.column(0), get)
                    keep = flat >= 0
                    ends = np.concatenate([[0], np.cumsum(np.bincount(row[keep], minlength=len(n)))])
                    yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat[keep]))], names=["x"])

            yield from _multiply(numbered(), total)

        partial = baskets.select(filled).mapInArrow(encode_and_multiply, schema)
    else:

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            get = shared.value.get
            for b in batches:
                row, flat, _, names = _encoded(b.column(1), get)
                r = b.column(0).to_numpy(zero_copy_only=False)[row]
                item = pa.array([None if k >= 0 else x for k, x in zip(flat.tolist(), names, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(r), pa.array(flat, pa.int64(), mask=flat < 0), item], names=["r", "i", "item"])

        # an id must not change between attempts, so the entries are a table
        entries = written(baskets.select(F.monotonically_increasing_id().alias("r"), filled).mapInArrow(encode, "r bigint, i bigint, item string"))
        rest = entries.where("item is not null").select("r", "item").join(known.select("item", "i"), "item").select("r", "i")
        rows = entries.where("i is not null").select("r", "i").unionByName(rest).groupBy("r").agg(F.collect_list("i").alias("x"))
        partial = rows.select("x").mapInArrow(lambda batches: _multiply(batches, total), schema)
    both = written(partial.groupBy("a", "b").agg(F.sum("n").alias("n_ab")).where(F.col("n_ab") >= support))
    names = hinted(known, BROADCAST_ROWS)
    a = names.select(F.col("i").alias("a"), F.col("item").alias("termino_a"), F.col("count").alias("n_a"))
    b = names.select(F.col("i").alias("b"), F.col("item").alias("termino_b"), F.col("count").alias("n_b"))
    return both.join(a, "a").join(b, "b").select("termino_a", "termino_b", "n_a", "n_b", "n_ab")


def measured(pairs: DataFrame, baskets: int) -> DataFrame:
    """With the counts expected by chance: ``elevacion`` = n_ab * N / (n_a * n_b) and normalised pointwise mutual
    information ``npmi`` (1 where the pair is in every basket)."""
    n = F.lit(float(baskets))
    lift = F.col("n_ab") * n / (F.col("n_a").cast("double") * F.col("n_b"))
    return pairs.withColumn("elevacion", lift).withColumn("npmi", F.when(F.col("n_ab") == baskets, 1.0).otherwise(F.log(lift) / -F.log(F.col("n_ab") / n)))


def title_baskets(noticias: DataFrame) -> DataFrame:
    """(items) of every article with a non-blank title, as a table."""
    return written(consistent_titles(noticias).where("forma <> ''").select(words(F.col("forma")).alias("items")))


def written_pairs(noticias: DataFrame, least: int = 4) -> DataFrame:
    """The pairs of words, as the titles have them in lower case, in at least ``least`` titles, with their lift."""
    baskets = written(articles(noticias, "titulo").where(F.trim("titulo") != "").select(words(F.col("titulo")).alias("items")))
    return measured(pair_counts(baskets, support=least), baskets.count()).drop("npmi")


def title_pairs(noticias: DataFrame, least: int = 4, share: float = 1 / 2000) -> DataFrame:
    """The pairs of words in at least ``least`` titles and ``share`` of all, with their measures."""
    baskets = title_baskets(noticias)
    n = baskets.count()
    support = max(least, int(np.ceil(n * share - 1e-9)))
    return measured(pair_counts(baskets, support=support), n).withColumn("n", F.lit(n))


def associated_pairs(noticias: DataFrame, times: int = 20) -> DataFrame:
    """(termino_a, termino_b): pairs that meet at least ``times`` as often as by chance."""
    by_chance = F.col("n_a") * F.col("n_b") * times
    return title_pairs(noticias).where(F.col("n_ab") * F.col("n") >= by_chance).select("termino_a", "termino_b")
