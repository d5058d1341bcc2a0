"""Problem 2: the frequency of every distinct value, by heavy-light aggregation.

Values that take a large share of the rows (found on a bounded sample, which decides only the way a value takes, never
its result) are numbered and broadcast.  One pass over the table parts the rows before anything is shuffled: those of
heavy values go into exact local arrays, numbered by value, from which each task hands on every distinct (record, row)
once, spread by record; those of all other values are shuffled by value, in one exchange that serves the removal of
copies, the records and the sums alike.  Both count tables together are the result.

Exactly equal rows may lie in different tasks, so the partial of a heavy value is the set of its distinct rows, not yet
their sum.

Values are compared in lower case, accents composed, white space trimmed and squeezed; blank and null values are left
out.  Exactly equal rows count once.  Null weights count as 0.  A record is a distinct combination of ``records``.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kiosko.plans.common import written

#: A value is heavy from this share of the sampled rows on, so there are at most 1 / HEAVY heavy values.
HEAVY = 1 / 4000
#: Rows of the sample that finds them, about: its fraction is set by the size of the table at ROW_BYTES a row.
SAMPLE, ROW_BYTES = 400_000, 16
#: Rows of heavy values that a task holds before it hands them on, and the parts over which a heavy value is spread.
HELD, SALTS = 1 << 19, 4096
#: Spellings whose normal form a task keeps; beyond, it starts anew.
CACHED = 1 << 18


def normal(text: str) -> str:
    return unicodedata.normalize("NFC", " ".join(text.lower().split()))


def heavy_values(values: DataFrame, share: float = HEAVY, sample: int = SAMPLE) -> list[str]:
    """The values of a column that take at least ``share`` of a bounded sample of its rows."""
    size = int(str(values._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    rows = values.count() if size >= 1 << 60 else size // ROW_BYTES  # no size is known of rows that aren't of files
    fraction = min(1.0, sample / max(1, rows))
    if fraction < 1.0:
        values = values.sample(fraction, seed=7)
    seen = Observation()
    some = values.select(F.trim(F.regexp_replace(F.lower(values.columns[0]), " +", " ")).alias("v")).where("v <> ''").observe(seen, F.count("*").alias("n"))
    most = some.groupBy("v").count().orderBy(F.desc("count"), "v").limit(max(1, int(1 / share))).collect()
    return sorted({v for r in most if r["count"] >= max(2.0, share * seen.get["n"]) and (v := normal(r.v))})


def _hashed(*columns: str) -> list[Column]:
    """What to hash, so that nulls in different columns differ."""
    return [sum((F.when(F.col(c).isNull(), 1 << i).otherwise(0) for i, c in enumerate(columns)), F.lit(0)), *map(F.col, columns)]


class _Split:
    """One task's rows (v, w, r1, r2, row): those of light values pass, those of heavy ones are held in local arrays."""

    def __init__(self, heavy: dict[str, int]):
        self.heavy = heavy
        self.names = pa.array(list(heavy), pa.string())
        self.form: dict[str, str] = {}
        self.held: list[np.ndarray] = []
        self.size = 0

    def forms(self, spellings: list[str]) -> list[str]:
        if len(self.form) > CACHED:
            self.form = {}
        get, out = self.form.get, []
        for x in spellings:
            f = get(x)
            if f is None:
                f = self.form[x] = normal(x)
            out.append(f)
        return out

    def distinct(self) -> np.ndarray:
        rows = np.concatenate(self.held)
        return rows[np.unique(rows[:, [0, 4]], axis=0, return_index=True)[1]]  # a row is of one record, with one weight

    def partials(self) -> pa.RecordBatch:
        rows = self.distinct()
        self.held, self.size = [], 0
        salt = 1 + (rows[:, 2] % SALTS)
        return self.batch(self.names.take(pa.array(rows[:, 0])), salt, *(pa.array(rows[:, j]) for j in (1, 2, 3, 4)))

    @staticmethod
    def batch(value, salt, w, r1, r2, row) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([value, pa.array(salt, pa.int32()), w, r1, r2, row], names=["valor", "parte", "w", "r1", "r2", "fila"])

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            coded = b.column(0).dictionary_encode()
            forms = self.forms(coded.dictionary.to_pylist())
            at = coded.indices.to_numpy(zero_copy_only=False)
            number = np.fromiter((self.heavy.get(f, -1 if f else -2) for f in forms), np.int64, len(forms))[at]
            light = np.flatnonzero(number == -1)
            if len(light):
                take = pa.array(light)
                yield self.batch(pa.array(forms, pa.string()).take(pa.array(at[light])), np.zeros(len(light), np.int32), *(b.column(j).take(take) for j in (1, 2, 3, 4)))
            hot = np.flatnonzero(number >= 0)
            if len(hot):
                self.held.append(np.column_stack([number[hot], *(b.column(j).to_numpy(zero_copy_only=False)[hot].astype(np.int64) for j in (1, 2, 3, 4))]))
                self.size += len(hot)
                if self.size > HELD:
                    self.held = [self.distinct()]
                    self.size = len(self.held[0])
                    if self.size > HELD // 2:
                        yield self.partials()
        if self.held:
            yield self.partials()


def frequencies(table: DataFrame, value: str, weight: str, records: list[str], share: float = HEAVY) -> DataFrame:
    """(valor, ocurrencias, registros) of every distinct value."""
    return _counted(table, value, weight, records, share)[0]


def _counted(table: DataFrame, value: str, weight: str, records: list[str], share: float) -> tuple[DataFrame, int]:
    """The counts, from a written table, and the sum of all occurrences."""
    heavy = heavy_values(table.select(value), share)
    shared = table.sparkSession.sparkContext.broadcast({v: i for i, v in enumerate(heavy)})  # at most 1 / share
    rows = table.where(F.col(value).isNotNull()).select(
        F.col(value), F.coalesce(F.col(weight), F.lit(0)).cast("bigint"), F.xxhash64(*_hashed(*records)), F.hash(*_hashed(*records)).cast("bigint"), F.xxhash64(*_hashed(*table.columns))
    )
    parts = rows.mapInArrow(lambda batches: _Split(shared.value).run(batches), "valor string, parte int, w bigint, r1 bigint, r2 bigint, fila bigint")
    parts = parts.repartition("valor", "parte")  # the one exchange; no group is hot, for heavy values have parts
    rest = parts.groupBy("valor", "parte", "r1", "r2", "fila").agg(F.max("w").alias("w"))
    rest = rest.groupBy("valor", "parte", "r1", "r2").agg(F.sum("w").alias("w"))
    rest = rest.groupBy("valor", "parte").agg(F.sum("w").alias("ocurrencias"), F.count("*").alias("registros"))
    seen = Observation()
    both = written(rest.withColumn("pesado", F.col("parte") > 0).observe(seen, F.sum("ocurrencias").alias("total")), "pesado")
    merged = both.where("pesado").groupBy("valor").agg(F.sum("ocurrencias").alias("ocurrencias"), F.sum("registros").alias("registros"))
    return both.where("not pesado").select("valor", "ocurrencias", "registros").unionByName(merged), seen.get["total"] or 0


def marked(table: DataFrame, value: str, weight: str, records: list[str], rare: int = 2, common: float = 0.005, share: float = HEAVY) -> DataFrame:
    """(valor, ocurrencias, registros, raro, comun): ``raro`` are those in at most ``rare`` records, ``comun`` those with
    at least ``common`` of all occurrences."""
    counts, total = _counted(table, value, weight, records, share)
    return counts.select("*", (F.col("registros") <= rare).alias("raro"), (F.col("ocurrencias") + 1e-9 >= F.lit(total) * common).alias("comun"))


def title_frequencies(terms: DataFrame, ngrams: DataFrame) -> DataFrame:
    """(campo, valor, ocurrencias, registros, raro, comun) of both tables of titles."""
    a = marked(terms, "termino", "frecuencia", ["fecha", "fuente"]).withColumn("campo", F.lit("termino"))
    b = marked(ngrams, "ngrama", "n", ["fecha"]).withColumn("campo", F.lit("ngrama"))
    return a.unionByName(b).select("campo", "valor", "ocurrencias", "registros", "raro", "comun")


def marks(terms: DataFrame, ngrams: DataFrame) -> DataFrame:
    """(campo, valor, marca): a row for each mark of each value."""
    both = F.array_compact(F.array(F.when(F.col("raro"), F.lit("raro")), F.when(F.col("comun"), F.lit("comun"))))
    return title_frequencies(terms, ngrams).select("campo", "valor", F.explode(both).alias("marca"))
