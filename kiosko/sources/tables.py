"""Tables kept as Parquet, partitioned by a date: upserts, rewrites from a date on, coverage.

Plain Parquet has no MERGE.  A write replaces exactly the partitions that change (dynamic partition overwrite), so an
upsert reads and writes only the dates of its batch.  The new partitions are first written as a table of their own in
the shared folder, for they are read from the table that they replace.
"""

from __future__ import annotations

import datetime
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiosko.plans.common import files, written


_TYPES = {
    "string": T.StringType(), "date": T.DateType(), "timestamp": T.TimestampType(), "int": T.IntegerType(), "smallint": T.ShortType(), "bigint": T.LongType(),
    "double": T.DoubleType(), "decimal(10,6)": T.DecimalType(10, 6), "array<float>": T.ArrayType(T.FloatType()),
}


def _type(text: str) -> T.StructType:
    """A schema from "name type, ..."; unlike Spark's own parser, without a session."""
    pairs = [x.strip().split(" ", 1) for x in re.split(r",(?![^(]*\))", text)]
    return T.StructType([T.StructField(n.strip("`"), _TYPES[t]) for n, t in pairs])


#: The schemas of all relations.
SCHEMAS: dict[str, T.StructType] = {
    "noticias": _type("id string, titulo string, bajada string, cuerpo string, cuerpo_limpio string, fecha date, fecha_scraping date, url string, fuente string, `año` int, created_at timestamp"),
    "titulos_terminos_diarios": _type("fecha date, termino string, frecuencia int"),
    "metricas_titulos_diarias": _type("fecha date, total_noticias int, terminos_unicos int, actualizado_en timestamp"),
    "titulos_terminos_por_medio": _type("fecha date, fuente string, termino string, frecuencia int"),
    "titulos_coocurrencia": _type("fecha date, fuente string, termino_a string, termino_b string, n int"),
    "noticias_sentimiento": _type("id string, sentimiento string, modelo string, procesado_en timestamp, confianza int, prompt_version string"),
    "sentimiento_errores": _type("id string, intentos int, ultima_vez timestamp"),
    "terminos_semanales": _type("semana int, fecha_inicio date, termino string, n int, p_semana decimal(10,6)"),
    "terminos_semanales_fuente": _type("semana int, fecha_inicio date, fuente string, termino string, n int, p_semana decimal(10,6)"),
    "terminos_semanales_sentimiento": _type("semana int, fecha_inicio date, sentimiento string, n_noticias int"),
    "actores_sentimiento": _type("fecha date, fuente string, actor string, sentimiento string, n int, tipo string"),
    "titulos_ngramas_diarios": _type("fecha date, ngrama string, n int, tipo smallint"),
    "titulos_ngramas_por_medio": _type("fecha date, fuente string, ngrama string, n int, tipo smallint"),
    "titulos_tfidf_por_medio": _type("fecha_semana date, fuente string, termino string, tfidf double, tipo smallint"),
    "cuerpo_terminos_diarios": _type("fecha date, termino string, frecuencia int"),
    "cuerpo_ngramas_diarios": _type("fecha date, ngrama string, n int, tipo smallint"),
    "noticias_embeddings_meta": _type("id string, embebido_en timestamp, modelo string, store_version int"),
    "noticias_clusters": _type("fecha date, id_noticia string, cluster_id int, score_centroide double"),
    "analisis_cobertura": _type("analisis string, fecha date, n_noticias int"),
}


class Table:
    """A table in a folder, partitioned by ``date`` (or not at all)."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, date: str | None = "fecha"):
        self.spark, self.folder, self.schema, self.date = spark, folder.rstrip("/"), schema, date

    def _files(self, suffix: str = ""):
        return files(self.spark, self.folder + suffix)

    def _recover(self) -> bool:
        """Whether the table is there.  A replacement that was cut off between its two renames is taken back."""
        path, fs = self._files()
        old, _ = self._files(_OLD)
        if not fs.exists(path) and fs.exists(old):
            fs.rename(old, path)
        return fs.exists(path)

    def read(self) -> DataFrame:
        if not self._recover():
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.folder).select(self.schema.names)

    def _put(self, rows: DataFrame, mode: str, suffix: str = "") -> None:
        out = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema])
        if self.date is not None:  # rows without a date are left out
            out = out.where(F.col(self.date).isNotNull())
        if self.date is None:
            out.write.mode(mode).parquet(self.folder + suffix)
        else:  # by date, a date of very many rows in several files
            out.hint("rebalance", self.date).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(self.date).parquet(self.folder + suffix)

    def overwrite(self, rows: DataFrame) -> None:
        """Replaces the whole table.  The new one is written beside the old one, which is there until two renames."""
        self._recover()
        path, fs = self._files()
        new, old = self._files(_NEW)[0], self._files(_OLD)[0]
        fs.delete(new, True)
        self._put(rows, "overwrite", _NEW)
        fs.delete(old, True)
        if fs.exists(path):
            fs.rename(path, old)
        fs.rename(new, path)
        fs.delete(old, True)

    def truncate(self) -> None:
        path, fs = self._files()
        fs.delete(path, True)
        fs.delete(self._files(_OLD)[0], True)

    def _dates(self, rows: DataFrame) -> list[datetime.date]:
        return [r[0] for r in rows.where(F.col(self.date).isNotNull()).select(self.date).distinct().collect()]  # one row a day

    def _drop(self, days: set[datetime.date]) -> None:
        """Removes the partitions of some days."""
        root, fs = self._files()
        for s in fs.listStatus(root) if fs.exists(root) else []:
            name = s.getPath().getName()
            if name.startswith(f"{self.date}=") and "__HIVE" not in name and datetime.date.fromisoformat(name.partition("=")[2]) in days:
                fs.delete(s.getPath(), True)

    def append_new(self, rows: DataFrame, *keys: str) -> None:
        """Inserts rows whose key isn't there yet; of rows with equal keys the least."""
        self._put(written(least_of(rows.select(self.schema.names), *keys).join(self._with_dates_of(rows, keys).select(*keys), list(keys), "left_anti")), "append")

    def _with_dates_of(self, rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
        """The rows of the table that may have the keys of ``rows``: if the date is one of the keys, only those of its dates."""
        old = self.read()
        return old.where(F.col(self.date).isin(self._dates(rows))) if self.date in keys else old

    def upsert(self, rows: DataFrame, *keys: str, keep: tuple[str, ...] = ()) -> None:
        """Inserts rows, or updates those with equal keys; ``keep`` columns keep the older value.

        The batch is written first, with one row a key (the least of equals).  If the keys hold the partition date, only
        the dates of the batch are read; else the keys and dates of the whole table are, to find the rows to replace.
        Only partitions that change are written.
        """
        rows = written(least_of(rows.select(self.schema.names), *keys))
        old = self._with_dates_of(rows, keys)
        if keep:
            before = old.select(*keys, *[F.col(c).alias(f"_{c}") for c in keep])
            rows = written(rows.join(before, list(keys), "left").withColumns({c: F.coalesce(f"_{c}", c) for c in keep}).select(self.schema.names))
        if self.date is None:
            self.overwrite(written(old.join(rows.select(*keys), list(keys), "left_anti").unionByName(rows)))
            return
        touched = set(self._dates(rows)) | (set() if self.date in keys else set(self._dates(old.join(rows.select(*keys), list(keys), "left_semi"))))
        rest = self.read().where(F.col(self.date).isin(sorted(touched))).join(rows.select(*keys), list(keys), "left_anti")
        self._replace(rest.unionByName(rows), touched)

    def _replace(self, rows: DataFrame, days: set[datetime.date]) -> None:
        """Puts ``rows`` in the place of all rows of ``days``."""
        fresh = written(rows)
        self._put(fresh, "overwrite")
        self._drop(days - set(self._dates(fresh)))

    def rewrite_from(self, rows: DataFrame, start: datetime.date) -> None:
        """Deletes all rows of ``start`` and later and inserts ``rows``, which must be of such dates."""
        late = {d for d in self._dates(self.read()) if d >= start}
        self._replace(rows.where(F.col(self.date) >= F.lit(start)), late)

    def delete_with(self, gone: DataFrame, *keys: str) -> None:
        """Deletes the rows whose key is in ``gone`` (a cascade); only the dates that have such rows are rewritten."""
        gone = written(gone.select(*keys).distinct())
        old = self.read()
        if self.date is None:
            self.overwrite(written(old.join(gone, list(keys), "left_anti")))
            return
        touched = set(self._dates(old.join(gone, list(keys), "left_semi")))
        self._replace(old.where(F.col(self.date).isin(sorted(touched))).join(gone, list(keys), "left_anti"), touched)


_NEW, _OLD = "__new", "__old"


def least_of(rows: DataFrame, *keys: str) -> DataFrame:
    """One row a key, the least of equals by its other columns in order; combined before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return rows.distinct()
    return rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_x")).select(*keys, "_x.*").select(rows.columns)


def first_of(rows: DataFrame, keys: list[str], *order) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


def coverage(rows: DataFrame, name: str) -> DataFrame:
    """(analisis, fecha, n_noticias): what an analysis has seen."""
    return rows.groupBy("fecha").agg(F.count("*").cast("int").alias("n_noticias")).select(F.lit(name).alias("analisis"), "fecha", "n_noticias")


def drift(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """(fecha, ahora, antes): days whose number of articles differs from the coverage, or that it lacks."""
    now = rows.groupBy("fecha").agg(F.count("*").cast("int").alias("ahora"))
    old = seen.select("fecha", F.col("n_noticias").alias("antes"))
    return now.join(old, "fecha", "left").where("antes is null or antes <> ahora")


def start_date(rows: DataFrame, seen: DataFrame) -> datetime.date | None:
    """Where a run has to begin: the day before the last one seen, or the first day that has drifted, if earlier.
    None if nothing was ever seen (a full run)."""
    last = seen.agg(F.max("fecha")).first()[0]
    if last is None:
        return None
    first = drift(rows, seen).agg(F.min("fecha")).first()[0]
    begin = last - datetime.timedelta(days=1)
    return begin if first is None else min(begin, first)


def checks(rows: DataFrame, *columns: str, longest: int = 150) -> DataFrame:
    """One row: rows, and for each column the nulls and the values that are too long."""
    out = [F.count("*").alias("filas")]
    for c in columns:
        out += [F.count(F.when(F.col(c).isNull(), 1)).alias(f"{c}_nulos"), F.count(F.when(F.length(c) > longest, 1)).alias(f"{c}_largos")]
    return rows.agg(*out)
