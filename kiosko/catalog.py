"""The queries of the core, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kiosko.plans.common import read
from kiosko.queries import dashboard, ingest, sentiment, stored, titles
from kiosko.streaming import late

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return late.late_articles(read(spark, d, "noticias"))


def p1_daily_counts(spark: SparkSession, d: str) -> DataFrame:
    return late.aggregates(late.corrections(late.arrivals(read(spark, d, "noticias")), "fecha", "llegada"))


def p1_corrections(spark: SparkSession, d: str) -> DataFrame:
    log = late.corrections(late.arrivals(read(spark, d, "noticias")), "fecha", "llegada")
    return log.select("llegada", "fecha", "n", "efecto", "antes", "despues")


QUERIES: dict[str, Query] = {f.__name__: f for f in (p1_found, p1_daily_counts, p1_corrections)}
for _m in (titles, dashboard, sentiment, ingest, stored):
    QUERIES |= _m.QUERIES

_LATE = """
  art AS (SELECT id, min(fecha) AS fecha, min(coalesce(fecha_scraping, CAST(created_at AS DATE))) AS llegada FROM noticias WHERE id IS NOT NULL GROUP BY id),
  d AS (SELECT llegada, max(CASE WHEN fecha <= llegada THEN fecha END) AS tope FROM art WHERE fecha IS NOT NULL AND llegada IS NOT NULL GROUP BY llegada),
  m AS (SELECT llegada, max(tope) OVER (ORDER BY llegada ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS marca FROM d),
  e AS (SELECT id, art.llegada, fecha, CASE WHEN marca IS NOT NULL AND fecha < marca - 10 THEN 'excluida' WHEN fecha > art.llegada THEN 'adelantada'
        WHEN marca IS NOT NULL AND fecha < marca THEN 'corrige' ELSE 'en_plazo' END AS efecto FROM art JOIN m ON art.llegada = m.llegada WHERE fecha IS NOT NULL)"""

ORACLE: dict[str, str] = {
    "p1_found": f"WITH {_LATE} SELECT id, efecto FROM e WHERE efecto IN ('corrige', 'excluida')",
    "p1_daily_counts": f"""WITH {_LATE} SELECT fecha, sum((efecto <> 'excluida')::INT)::BIGINT AS total, sum((efecto IN ('en_plazo', 'adelantada'))::INT)::BIGINT AS en_plazo,
      sum((efecto = 'corrige')::INT)::BIGINT AS corrigen, sum((efecto = 'excluida')::INT)::BIGINT AS excluidas FROM e GROUP BY fecha""",
    "p1_corrections": f"""WITH {_LATE}, p AS (SELECT llegada, fecha, efecto, count(*) AS n FROM e GROUP BY ALL),
      c AS (SELECT *, coalesce(sum(CASE WHEN efecto <> 'excluida' THEN n END) OVER (PARTITION BY fecha ORDER BY llegada), 0)::BIGINT AS despues FROM p)
      SELECT llegada, fecha, n, efecto, (despues - CASE WHEN efecto <> 'excluida' THEN n ELSE 0 END)::BIGINT AS antes, despues FROM c""",
}
for _m in (titles, dashboard, sentiment, ingest, stored):
    ORACLE |= _m.ORACLE
