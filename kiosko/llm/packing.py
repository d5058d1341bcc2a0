"""Problem 6: filling containers of fixed capacity with texts measured in tokens.

Only the histogram of sizes (at most ``capacity`` rows, whatever the number of texts) reaches the driver, where the
packing is planned:

1. the patterns are all sets of one to three sizes that fill a container exactly.  They grow with the square of the
   capacity, so they are not listed: non-negative least squares is solved over all of them by column generation, which
   adds, round after round, for each size the pattern that lowers the error most;
2. the fit of the patterns' repeat counts to the histogram gives small sizes less weight, for they fit into any gap;
3. the counts are rounded to what the histogram holds;
4. the residual is packed best-fit-decreasing, a whole size class at a time, patterns of many texts growing in gaps.

The plan is a list of patterns with repeat counts; it grows with the capacity, not with the number of texts.  Texts are
then numbered within their size (in salted groups, so that a hot size is no hot task; the numbers that precede each group
are summed by Spark) and take the slots of their size in order.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiosko.plans.common import written

CAPACITY = 2048
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern by which the vocabulary's tokenizer parts a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Rows that one numbering task has at most, about.
GROUP_ROWS = 500_000
#: A pattern joins the fit if the weighted counts that its sizes lack sum up to more.
LEAST_GAIN = 0.25


@lru_cache(maxsize=2)
def tokenizer(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("kiosko", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """(doc_id, tokens) of every row; null texts have 0."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).encode_ordinary
        for b in batches:
            n = [len(encode(x)) if x else 0 for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], names=["doc_id", "tokens"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(count, f"doc_id {kind}, tokens bigint")


def best_patterns(gain: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(patterns, scores): for each size a the pattern (a, b, c), a >= b >= c >= 0, a + b + c = capacity, of sizes that
    are there, with the highest sum of ``gain`` (0 for c = 0)."""
    capacity = len(gain) - 1
    value = np.where(there, gain, -np.inf)
    value[0] = 0.0
    out, score = [], []
    for a in np.flatnonzero(there)[::-1].tolist():
        rest = capacity - a
        lo, hi = (rest + 1) // 2, min(a, rest)
        if hi < lo:
            continue
        both = value[lo : hi + 1] + value[rest - hi : rest - lo + 1][::-1]  # b, and c = rest - b
        k = int(np.argmax(both))
        if both[k] > -np.inf:
            out.append((a, lo + k, rest - lo - k))
            score.append(value[a] + both[k])
    return np.array(out, np.int64).reshape(-1, 3), np.array(score)


def pairs(there: np.ndarray) -> np.ndarray:
    """The patterns of one or two sizes, as rows of three."""
    capacity = len(there) - 1
    a = np.arange(capacity, (capacity + 1) // 2 - 1, -1)
    b = capacity - a
    ok = there[a] & (there[b] | (b == 0))
    return np.stack([a[ok], b[ok], 0 * b[ok]], axis=1)


def fit_counts(histogram: np.ndarray, weight: np.ndarray, rounds: int = 60, steps: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """(patterns, x): non-negative least squares over all patterns of one to three sizes, repeat counts x >= 0 that
    minimise |weight * (A x - histogram)|.

    Column generation: each round adds the best pattern of every size that would lower the error, then improves x by
    accelerated projected gradient; A has at most three entries a column, so a step costs three gathers and scatters.
    """
    size = len(histogram)
    there = histogram > 0
    w2 = weight**2
    pats, x = np.zeros((0, 3), np.int64), np.zeros(0)
    known: set[tuple[int, int, int]] = set()
    total = lambda v: np.bincount(pats.ravel(), weights=np.repeat(v, 3), minlength=size)
    for i in range(rounds):
        left = histogram - total(x)
        left[0] = 0.0
        if i:
            found, score = best_patterns(w2 * left, there)
            found = found[score > LEAST_GAIN]
        else:
            found = pairs(there)  # first, for a large text has no other partner
        new = [p for p in map(tuple, found.tolist()) if p not in known]
        if not new and i:
            break
        if not new:
            continue
        known.update(new)
        pats, x = np.concatenate([pats, np.array(new, np.int64)]), np.concatenate([x, np.zeros(len(new))])
        used = (pats > 0).astype(float)
        gather = lambda u: (u[pats] * used).sum(axis=1)
        v = np.ones(len(pats))  # a bound of the largest eigenvalue of A' W A, by power iteration
        for _ in range(8):
            u = total(v)
            u[0] = 0.0
            v = gather(w2 * u)
            top = np.linalg.norm(v) or 1.0
            v /= top
        step, y, t = 1.0 / (1.1 * top), x.copy(), 1.0
        for _ in range(steps):
            over = total(y) - histogram
            over[0] = 0.0
            nx = np.maximum(y - step * gather(w2 * over), 0)
            nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
            y, x, t = nx + (t - 1) / nt * (nx - x), nx, nt
    return pats, x


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """[(sizes in the container, descending), number of such containers].  Sizes are 1 to ``capacity``."""
    left = np.zeros(capacity + 1, np.int64)
    for s, n in histogram.items():
        left[s] += n
    out: list[tuple[tuple[int, ...], int]] = []
    weight = np.where(np.arange(capacity + 1) < capacity // 4, 0.3, 1.0)
    weight[0] = 0
    scale = max(1.0, left.max() / 1e6)  # keeps the steps well conditioned for any number of texts
    pats, x = fit_counts(left / scale, weight)
    x = x * scale
    for i in np.argsort(-x, kind="stable")[: int((x >= 0.5).sum())].tolist():
        p = tuple(int(v) for v in pats[i] if v)
        need = {s: p.count(s) for s in p}
        n = min(int(round(x[i])), *(int(left[s]) // k for s, k in need.items()))
        if n > 0:
            out.append((p, n))
            for s, k in need.items():
                left[s] -= n * k
    return out + residual(left, capacity)


def residual(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit-decreasing of what the patterns left: largest first, a size class at a time into the fullest containers
    that have room."""
    room: dict[int, dict[tuple[int, ...], int]] = {}
    rooms: list[int] = []  # the keys of ``room``, sorted

    def put(r: int, p: tuple[int, ...], n: int) -> None:
        if r not in room:
            room[r] = {}
            insort(rooms, r)
        room[r][p] = room[r].get(p, 0) + n

    for s in np.flatnonzero(left)[::-1].tolist():
        n = int(left[s])
        at = bisect_left(rooms, s)
        grown: list[tuple[int, tuple[int, ...], int]] = []
        while n and at < len(rooms):
            r = rooms[at]
            for p in list(room[r]):
                have, k = room[r].pop(p), r // s
                full = min(have, n // k)  # containers that take k more
                if full:
                    grown.append((r - k * s, p + (s,) * k, full))
                n -= full * k
                have -= full
                if have and n and n < k:  # one container takes the rest
                    grown.append((r - n * s, p + (s,) * n, 1))
                    have, n = have - 1, 0
                if have:
                    room[r][p] = have
                if not n:
                    break
            if room[r]:
                at += 1
            else:
                del room[r], rooms[at]
        for g in grown:
            put(*g)
        k = capacity // s
        if n >= k:
            put(capacity - k * s, (s,) * k, n // k)
        if n % k:
            put(capacity - s * (n % k), (s,) * (n % k), 1)
    return [x for ps in room.values() for x in ps.items()]


class Slots:
    """The plan by size: runs of slots, for a binary search."""

    def __init__(self, planned: list[tuple[tuple[int, ...], int]]):
        runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # size: (first slot, first container, per container)
        slots: dict[int, int] = defaultdict(int)
        container = 0
        for p, n in planned:
            for s in dict.fromkeys(p):
                k = p.count(s)
                runs[s].append((slots[s], container, k))
                slots[s] += n * k
            container += n
        self.containers = container
        self.runs = {s: np.array(x, np.int64).T for s, x in runs.items()}

    def container(self, size: np.ndarray, number: np.ndarray) -> np.ndarray:
        """The container of the ``number``-th text (from 0) of each size; texts of size 0 are spread over all."""
        out = np.zeros(len(size), np.int64)
        for s in np.unique(size).tolist():
            at = size == s
            if s not in self.runs:
                out[at] = number[at] % max(1, self.containers)
                continue
            slot, first, per = self.runs[s]
            i = np.searchsorted(slot, number[at], side="right") - 1
            out[at] = first[i] + (number[at] - slot[i]) // per[i]
        return out


def pack(sizes: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(doc_id, pieza, desde, tokens, contenedor) from (doc_id, tokens).

    A text longer than the capacity is divided into pieces: full containers and a rest; every other text is one piece
    (``pieza`` 0) in one container.  ``desde`` is the first token of the piece.  Null and negative sizes count as 0;
    repeated ids are texts of their own.  ``sizes`` is read three times and should be a written table.
    """
    spark = sizes.sparkSession
    cap = F.lit(capacity).cast("bigint")
    size = F.greatest(F.coalesce("tokens", F.lit(0)), F.lit(0)).cast("bigint")
    cuts = F.greatest(F.ceil(size / cap), F.lit(1))
    pieces = sizes.select("doc_id", size.alias("total"), F.explode(F.sequence(F.lit(0).cast("bigint"), cuts - 1)).alias("pieza"))
    pieces = pieces.select("doc_id", "pieza", (F.col("pieza") * cap).alias("desde"), F.least(cap, F.col("total") - F.col("pieza") * cap).alias("tokens"))
    histogram = {r[0]: r[1] for r in pieces.groupBy("tokens").count().collect()}  # at most capacity + 1 rows
    salts = max(1, -(-sum(histogram.values()) // group_rows))
    spread = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).otherwise(F.xxhash64("doc_id", "pieza"))
    pieces = pieces.withColumn("_salt", F.pmod(spread, F.lit(salts)).cast("int"))
    before = Window.partitionBy("tokens").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)  # of one row a salt
    groups = pieces.groupBy("tokens", "_salt").count().select("tokens", "_salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first"))
    shared = spark.sparkContext.broadcast(Slots(plan({s: n for s, n in histogram.items() if s > 0}, capacity)))
    own = Window.partitionBy("tokens", "_salt").orderBy("doc_id", "pieza")
    numbered = pieces.withColumn("_n", F.row_number().over(own).cast("bigint") - 1).join(groups, ["tokens", "_salt"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = shared.value
        for b in batches:
            size, number, first = (b.column(c).to_numpy() for c in ("tokens", "_n", "_first"))
            out = pa.array(slots.container(size, first + number))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "pieza", "desde", "tokens")), out], names=["doc_id", "pieza", "desde", "tokens", "contenedor"])

    kind = sizes.schema["doc_id"].dataType.simpleString()
    return numbered.mapInArrow(place, f"doc_id {kind}, pieza bigint, desde bigint, tokens bigint, contenedor bigint")


def packed_documents(documents: DataFrame, capacity: int = CAPACITY, tokenizer_path: str = TOKENIZER) -> DataFrame:
    """Every text of ``documents`` in containers of ``capacity`` tokens.  Texts are counted once, into a table."""
    return pack(written(token_counts(documents, tokenizer_path)), capacity)


def fill_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: containers, tokens in them, tokens of room unused and its share."""
    by = packed.groupBy("contenedor").agg(F.sum("tokens").alias("t"))
    return by.agg(
        F.count("*").alias("contenedores"),
        F.sum("t").alias("tokens"),
        (F.count("*") * capacity - F.sum("t")).alias("sin_usar"),
        (1 - F.sum("t") / (F.count("*") * capacity)).alias("parte_sin_usar"),
    )


def invariants(documents: DataFrame, packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row that tells whether ``packed`` is a packing of ``documents``: its texts, those that are missing, those whose
    pieces aren't full but for the last, the containers above the capacity, and whether there are at most one in a hundred
    (and one) containers more than the tokens need."""
    texts = documents.groupBy("doc_id").agg(F.count("*").alias("_rows"))
    pieces = packed.groupBy("doc_id").agg(F.count("*").alias("_pieces"), F.sum("tokens").alias("_t"), F.sum(F.when(F.col("pieza") == 0, 1)).alias("_own"), F.max("pieza").alias("_last"))
    both = texts.join(pieces, texts["doc_id"].eqNullSafe(pieces["doc_id"]), "left")
    whole = (F.col("_pieces") == F.col("_rows") * (F.col("_last") + 1)) | (F.col("_rows") > 1)
    by_text = both.agg(
        F.sum("_rows").alias("textos"),
        F.sum(F.when(F.coalesce("_own", F.lit(0)) == F.col("_rows"), 0).otherwise(1)).alias("perdidos"),
        F.sum(F.when(whole & ((F.col("_last") == 0) | (F.col("_rows") > 1) | (F.col("_t") > F.col("_last") * capacity)), 0).otherwise(1)).alias("mal_divididos"),
    )
    by = packed.groupBy("contenedor").agg(F.sum("tokens").alias("t")).agg(
        F.sum(F.when(F.col("t") > capacity, 1).otherwise(0)).alias("excedidos"), (F.count("*") <= F.ceil(F.sum("t") / capacity) * 1.01 + 1).alias("ajustado")
    )
    return by_text.crossJoin(F.broadcast(by))  # one row each
