"""The questions of the dashboard."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiosko.functions import dictionaries as D
from kiosko.functions import text as X
from kiosko.functions.stem import stem


def excluded(base: frozenset[str] | list[str], own: str = "") -> list[str]:
    """Base stop words and a user's own, parted by commas."""
    return sorted({*base, *(w.strip().lower() for w in own.split(",") if w.strip())})


def between(rows: DataFrame, start: datetime.date | None = None, end: datetime.date | None = None, source: str | None = None) -> DataFrame:
    """Rows of a closed range of dates and a source; None leaves a condition out."""
    if start is not None:
        rows = rows.where(F.col("fecha") >= F.lit(start))
    if end is not None:
        rows = rows.where(F.col("fecha") <= F.lit(end))
    return rows if source is None else rows.where(F.col("fuente") == source)


def term_totals(terms: DataFrame, stopwords: list[str]) -> DataFrame:
    return terms.where(~F.col("termino").isin(stopwords)).groupBy("termino").agg(F.sum("frecuencia").alias("total"))


def series(terms: DataFrame, names: list[str]) -> DataFrame:
    """(fecha, termino, frecuencia) of some terms, in any case."""
    low = [n.lower() for n in names]
    return terms.where(F.lower("termino").isin(low)).groupBy("fecha", "termino").agg(F.sum("frecuencia").alias("frecuencia"))


def yearly(rows: DataFrame, value: str, *keys: str) -> DataFrame:
    return rows.groupBy(F.year("fecha").alias("anio"), *keys).agg(F.sum(value).alias(value))


def prefix_search(terms: DataFrame, prefix: str, n: int = 20) -> DataFrame:
    """(termino, total): terms that begin with ``prefix`` in any case; an equal term first, then by total."""
    escaped = prefix.lower().replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    found = terms.where(F.col("termino").ilike(escaped + "%")).groupBy("termino").agg(F.sum("frecuencia").alias("total"))
    exact = F.when(F.lower("termino") == prefix.lower(), 0).otherwise(1)
    return found.orderBy(exact, F.desc("total"), "termino").limit(n)


def first_per_stem(rows: list[tuple[str, int]], n: int = 6) -> list[tuple[str, int]]:
    """The first of the found terms of each stem, at most ``n``."""
    seen: dict[str, tuple[str, int]] = {}
    for term, total in rows:
        seen.setdefault(" ".join(map(stem, term.lower().split())), (term, total))
    return list(seen.values())[:n]


def titles_with_word(rows: DataFrame, word: str) -> DataFrame:
    return rows.where(F.col("titulo").rlike(X.whole_word(word)))


def page(rows: DataFrame, number: int, size: int, *order) -> DataFrame:
    """Page ``number``, from 1; ``order`` should end with a unique column."""
    return rows.orderBy(*order).offset(max(0, number - 1) * size).limit(size)


def pages(total: int, size: int = 5) -> int:
    return max(1, -(-total // size))


def volume(rows: DataFrame, *keys) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n"))


def volume_summary(daily: DataFrame) -> DataFrame:
    """(total, dias, media) of daily volumes (fecha, n)."""
    return daily.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("dias"), F.round(F.avg("n"), 1).alias("media"))


def dense(counts: DataFrame, row: str, column: str, value: str, columns: list[str], rows: DataFrame | None = None) -> DataFrame:
    """Every combination of a row value and one of ``columns``, 0 where ``counts`` has none.  The columns are stated, so
    each row value is exploded into them."""
    own = (counts.select(row) if rows is None else rows.select(row)).distinct()
    grid = own.withColumn(column, F.explode(F.array(*[F.lit(c) for c in columns])))
    have = counts.where(F.col(column).isin(columns)).groupBy(row, column).agg(F.sum(value).alias(value))
    return grid.join(have, [row, column], "left").withColumn(value, F.coalesce(value, F.lit(0)))


def gaps(rows: DataFrame) -> DataFrame:
    """(fuente, gap_dias, gap_desde, gap_hasta, ultima): each source's longest run of days without rows, the earliest
    of equals, and its last day.  0 and nulls for a source of one day."""
    days = rows.where("fuente is not null and fecha is not null").select("fuente", "fecha").distinct()
    prev = F.lag("fecha").over(Window.partitionBy("fuente").orderBy("fecha"))
    days = days.withColumn("prev", prev)
    best = days.groupBy("fuente").agg(
        F.max("fecha").alias("ultima"),
        F.min_by(F.struct("prev", "fecha"), F.when(F.col("prev").isNotNull(), F.struct(-F.datediff("fecha", "prev"), "fecha"))).alias("g"),
    )
    return best.select(
        "fuente",
        F.coalesce(F.datediff("g.fecha", "g.prev") - 1, F.lit(0)).alias("gap_dias"),
        F.date_add("g.prev", 1).alias("gap_desde"),
        F.date_sub("g.fecha", 1).alias("gap_hasta"),
        "ultima",
    )


def source_label(source: Column) -> Column:
    """The name by which a source is shown; its own where there is no other."""
    names = F.create_map(*[F.lit(x) for kv in D.SOURCE_LABELS.items() for x in kv])
    return F.coalesce(F.try_element_at(names, source), source)


def source_status(gap_rows: DataFrame, end: datetime.date, limit: int = 30, known: dict[str, str] | None = None) -> DataFrame:
    """With ``dias_inactivo``, ``estado`` and ``problema``: ``malo`` if a problem of the source is ``known`` or it is
    inactive, else ``gap`` if it has one, else ``ok``; the problem in words, empty if there is none."""
    idle = F.datediff(F.lit(end), F.col("ultima"))
    day = lambda c: F.date_format(c, "dd-MM-yyyy")
    fixed = F.lit(None).cast("string")
    for name, text in (known or {}).items():
        fixed = F.when(F.col("fuente") == name, text).otherwise(fixed)
    bad, gap = idle >= limit, F.col("gap_dias") >= limit
    state = F.when(fixed.isNotNull() | bad, "malo").when(gap, "gap").otherwise("ok")
    said = (
        F.when(fixed.isNotNull(), F.concat(F.lit("⛔ "), fixed))
        .when(bad, F.concat(F.lit("⛔ Inactivo: sin noticias desde el "), day("ultima"), F.lit(".")))
        .when(gap, F.concat(F.lit("⚠ Gap de datos: sin noticias del "), day("gap_desde"), F.lit(" al "), day("gap_hasta"), F.lit(" ("), F.col("gap_dias").cast("string"), F.lit(" días).")))
        .otherwise("")
    )
    return gap_rows.withColumn("dias_inactivo", idle).withColumn("estado", state).withColumn("problema", said)
