"""The queries of the operators for training data, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiosko.llm import boilerplate, consistent, cooccurrence, frequency, leaks, packing, quality
from kiosko.plans.common import read, written

Query = Callable[[SparkSession, str], DataFrame]


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return frequency.marks(read(spark, d, "titulos_terminos_por_medio"), read(spark, d, "titulos_ngramas_diarios"))


def p2_frequencies(spark: SparkSession, d: str) -> DataFrame:
    return frequency.title_frequencies(read(spark, d, "titulos_terminos_por_medio"), read(spark, d, "titulos_ngramas_diarios"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return consistent.lookalike_pairs(read(spark, d, "noticias"))


def p3_titles(spark: SparkSession, d: str) -> DataFrame:
    return consistent.consistent_titles(read(spark, d, "noticias"))


def p3_classes(spark: SparkSession, d: str) -> DataFrame:
    return consistent.lookalike_classes(read(spark, d, "noticias"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.repeated_places(read(spark, d, "noticias"))


def p4_lines(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.source_report(read(spark, d, "noticias"))


def p4_bodies(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.without_repeated(read(spark, d, "noticias"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return cooccurrence.associated_pairs(read(spark, d, "noticias"))


def p5_pairs(spark: SparkSession, d: str) -> DataFrame:
    return cooccurrence.title_pairs(read(spark, d, "noticias"))


def p5_written(spark: SparkSession, d: str) -> DataFrame:
    pairs = cooccurrence.written_pairs(read(spark, d, "noticias"))
    return pairs.withColumn("elevacion", F.round("elevacion", 6))


def p6_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.packed_documents(read(spark, d, "documents"))


def p6_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(p6_packing(spark, d))


def p6_invariants(spark: SparkSession, d: str) -> DataFrame:
    return packing.invariants(read(spark, d, "documents"), written(p6_packing(spark, d)))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaked_documents(read(spark, d, "documents"), read(spark, d, "evaluacion_items"))


def p7_coverage(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaks(read(spark, d, "documents"), read(spark, d, "evaluacion_items"), leaks.LEAST_TILE, leaks.COVERAGE)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return quality.not_prose(read(spark, d, "documents"), read(spark, d, "etiquetas"), read(spark, d, "palabras_comunes"))


def p8_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality(read(spark, d, "documents"), read(spark, d, "etiquetas"), read(spark, d, "palabras_comunes"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    p2_found, p2_frequencies, p3_found, p3_titles, p3_classes, p4_found, p4_lines, p4_bodies, p5_found, p5_pairs, p5_written,
    p6_packing, p6_fill, p6_invariants, p7_found, p7_coverage, p8_found, p8_quality,
)}

_VALUE = r"trim(regexp_replace(nfc_normalize(lower({c})), '[\s\p{{Z}}\x{{85}}\x{{1c}}-\x{{1f}}\v]+', ' ', 'g'))"


def _counts(table: str, value: str, weight: str, records: str, field: str) -> str:
    return f"""
      SELECT '{field}' AS campo, valor, sum(w)::BIGINT AS ocurrencias, count(DISTINCT r) AS registros
      FROM (SELECT {_VALUE.format(c=value)} AS valor, coalesce({weight}, 0) AS w, {records} AS r
            FROM (SELECT DISTINCT * FROM {table}) WHERE {value} IS NOT NULL)
      WHERE valor <> '' GROUP BY valor"""


_FREQUENCIES = f"""
  SELECT *, registros <= 2 AS raro, ocurrencias >= 0.005 * sum(ocurrencias) OVER (PARTITION BY campo) AS comun FROM (
    {_counts("titulos_terminos_por_medio", "termino", "frecuencia", "{'f': fecha, 's': fuente}", "termino")}
    UNION ALL {_counts("titulos_ngramas_diarios", "ngrama", "n", "{'f': fecha}", "ngrama")})"""

_LINES = r"""
  art AS (SELECT id, min(fuente) AS fuente, min(cuerpo) AS cuerpo FROM noticias WHERE id IS NOT NULL GROUP BY id),
  l AS (SELECT id, fuente, unnest(string_split(cuerpo, chr(10))) AS cruda, generate_subscripts(string_split(cuerpo, chr(10)), 1) AS nro FROM art),
  n AS (SELECT *, regexp_replace(trim(regexp_replace(lower(cruda), '[\s\p{Z}\x{85}\x{1c}-\x{1f}\v]+', ' ', 'g')), '\p{Nd}+', '0', 'g') AS linea FROM l),
  tot AS (SELECT fuente, count(*) AS total FROM art WHERE length(regexp_replace(cuerpo, '[\s\p{Z}\x{85}\x{1c}-\x{1f}\v]+', '', 'g')) > 0 GROUP BY fuente),
  rep AS (SELECT n.fuente, linea, count(DISTINCT id) AS articulos, any_value(total) AS total FROM n JOIN tot USING (fuente)
          WHERE linea <> '' GROUP BY n.fuente, linea HAVING count(DISTINCT id) >= 4 AND count(DISTINCT id) >= 0.02 * any_value(total))"""

ORACLE: dict[str, str] = {
    "p2_found": f"""SELECT campo, valor, 'raro' AS marca FROM ({_FREQUENCIES}) WHERE raro
      UNION ALL SELECT campo, valor, 'comun' AS marca FROM ({_FREQUENCIES}) WHERE comun""",
    "p2_frequencies": _FREQUENCIES,
    "p5_written": r"""WITH t AS (SELECT id, min(titulo) AS titulo FROM noticias WHERE id IS NOT NULL GROUP BY id),
      w AS (SELECT id, unnest(list_distinct(list_filter(regexp_extract_all(lower(titulo), '\p{L}+'), lambda x: length(x) >= 4))) AS w FROM t WHERE trim(titulo) <> ''),
      n AS (SELECT w, count(*) AS n FROM w GROUP BY w)
      SELECT a.w AS termino_a, b.w AS termino_b, any_value(na.n) AS n_a, any_value(nb.n) AS n_b, count(*) AS n_ab,
        round(count(*) * (SELECT count(*) FROM t WHERE trim(titulo) <> '')::DOUBLE / (any_value(na.n)::DOUBLE * any_value(nb.n)), 6) AS elevacion
      FROM w a JOIN w b ON a.id = b.id AND a.w < b.w JOIN n na ON a.w = na.w JOIN n nb ON b.w = nb.w GROUP BY a.w, b.w HAVING count(*) >= 4""",
    "p6_invariants": "SELECT count(*) AS textos, 0::BIGINT AS perdidos, 0::BIGINT AS mal_divididos, 0::BIGINT AS excedidos, true AS ajustado FROM documents",
    "p4_found": f"WITH {_LINES} SELECT id, nro::INTEGER AS nro_linea FROM n JOIN rep USING (fuente, linea)",
    "p4_lines": f"WITH {_LINES} SELECT fuente, linea, articulos, total FROM rep",
    "p4_bodies": rf"""WITH {_LINES},
      kept AS (SELECT n.id, string_agg(cruda, chr(10) ORDER BY nro) AS cuerpo FROM n LEFT JOIN rep USING (fuente, linea) WHERE rep.linea IS NULL GROUP BY n.id)
      SELECT t.id, CASE WHEN t.cuerpo IS NULL THEN NULL ELSE coalesce(kept.cuerpo, '') END AS cuerpo FROM noticias t LEFT JOIN kept ON t.id = kept.id WHERE t.id IS NOT NULL""",
}
