"""Queries over the tone of titles."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from kiosko.operators import sentiment as S
from kiosko.operators.dashboard import page
from kiosko.plans.common import read
from kiosko.queries import sql as Q
from kiosko.queries.dashboard import END, SOURCE, START
from kiosko.queries.titles import rows
from kiosko.sources import tables

NAME = "[A-ZÁÉÍÓÚÑ][a-záéíóúñ]+ [A-ZÁÉÍÓÚÑ][a-záéíóúñ]+"
LEAST_MONTH = 50  # results that make a month count in the test tables


def _results(spark, d):
    return read(spark, d, "noticias_sentimiento")


def _toned(spark, d):
    return S.with_tone(rows(spark, d), _results(spark, d))


def current_tone(spark, d):
    return S.current(_results(spark, d)).select("id", "sentimiento", "procesado_en", "modelo")


def sentiment_by_source(spark, d):
    return S.by_source(_toned(spark, d), 20)


def sentiment_counts(spark, d):
    return S.tone_counts(_toned(spark, d), "fuente")


def sentiment_evolution(spark, d):
    return S.tone_wide(_toned(spark, d), F.to_date(F.date_trunc("month", F.col("fecha"))).alias("mes"))


def sentiment_daily(spark, d):
    return S.tone_counts(_toned(spark, d), "fecha")


def sentiment_weekly(spark, d):
    week = F.to_date(F.date_trunc("week", F.col("fecha"))).alias("fecha_inicio")
    return S.tone_counts(_toned(spark, d), week).withColumnRenamed("n", "n_noticias")


def sentiment_net_prev(spark, d):
    return S.net_and_before(_toned(spark, d), datetime.date(2026, 3, 12), END)


def sentiment_coverage_islands(spark, d):
    return S.covered_months(_toned(spark, d), LEAST_MONTH)


def sentiment_meta(spark, d):
    return S.coverage(rows(spark, d), _results(spark, d))


def sentiment_page(spark, d):
    own = S.with_tone(rows(spark, d, START, END, SOURCE), _results(spark, d)).where("sentimiento = 'negativo'")
    return page(own, 1, 10, F.desc("fecha"), F.desc("procesado_en"), "id").select("id", "titulo", "fecha", "sentimiento")


def sentiment_sources(spark, d):
    return _toned(spark, d).select("fuente").distinct()


def pending_anti_join(spark, d):
    return S.pending(rows(spark, d), _results(spark, d)).select("id", "fecha").orderBy(F.desc_nulls_last("fecha"), "id").limit(500)


def pending_count(spark, d):
    return S.pending(rows(spark, d), _results(spark, d)).groupBy("fuente").agg(F.count("*").alias("n"))


def _actors(spark, d):
    """Actors are the proper names of two capitalised words in a title."""
    names = F.array_distinct(F.regexp_extract_all("titulo", F.lit(f"({NAME})"), F.lit(1)))
    return _toned(spark, d).withColumn("actor", F.explode(names))


def actor_net_tone(spark, d):
    return S.actors(_actors(spark, d))


def actor_daily(spark, d):
    return S.tone_counts(_actors(spark, d), "fecha", "fuente", "actor")


def confidence_normalised(spark, d):
    raw = F.when(F.col("confianza") % 2 == 0, F.col("confianza") / 100).otherwise(F.col("confianza"))
    return _results(spark, d).select("id", "procesado_en", S.confidence(raw).alias("confianza_norm"))


def model_distribution(spark, d):
    return S.current(_results(spark, d)).groupBy("modelo", "prompt_version").agg(F.count("*").alias("n"))


def lexicon_classify(spark, d):
    return S.classify(rows(spark, d), S.lexicon_answer)


def retry_counts(spark, d):
    """The error table after a run in which the articles without a current result failed once more."""
    old = _results(spark, d).groupBy("id").agg(F.count("*").cast("int").alias("intentos"), F.max("procesado_en").alias("ultima_vez"))
    failed = old.select("id").join(S.current(_results(spark, d)), "id", "left_anti")
    return S.failures(old, failed, F.lit("2026-04-01 00:00:00").cast("timestamp_ntz"))


def answers_parsed(spark, d):
    """An answer for each article with a tone, about two titles, in the three shapes and one that can't be read."""
    own = S.current(_results(spark, d))
    shape, label = F.length("id") + F.ascii(F.col("id")), F.col("sentimiento")
    text = (
        F.when(shape % 4 == 0, F.concat(F.lit('{"1": "'), label, F.lit('", "2": "otro"}')))
        .when(shape % 4 == 1, F.concat(F.lit('sin llave "2": "'), label, F.lit('"')))
        .when(shape % 4 == 2, F.concat(F.lit("1. "), F.upper(label), F.lit("\n")))
        .otherwise("nada")
    )
    return S.parsed(own.select(F.col("id").alias("lote"), text.alias("respuesta"), F.lit(2).alias("n")))


def errors_cleared(spark, d):
    """The error table after a run in which the articles of positive tone succeeded and the pending ones failed."""
    old = _results(spark, d).where("id is not null").groupBy("id").agg(F.count("*").cast("int").alias("intentos"), F.max("procesado_en").alias("ultima_vez"))
    done = S.current(_results(spark, d)).where("sentimiento = 'positivo'")
    return S.failures(old, S.pending(rows(spark, d), _results(spark, d)).select("id"), F.lit("2026-04-01 00:00:00").cast("timestamp_ntz"), done)


def retry_scan(spark, d):
    """The first 500 articles to be tried again."""
    old = _results(spark, d).where("id is not null").groupBy("id").agg(F.count("*").cast("int").alias("intentos"), F.max("procesado_en").alias("ultima_vez"))
    return S.retries(rows(spark, d), old).orderBy("ultima_vez", "id").limit(500).select("id", "titulo", "intentos", "ultima_vez")


def term_coverage_drift(spark, d):
    """Days whose articles differ from the day counts of the deliveries."""
    seen = tables.coverage(read(spark, d, "noticias"), "titulos")
    return tables.drift(rows(spark, d), seen)


QUERIES = {f.__name__: f for f in (
    current_tone, sentiment_by_source, sentiment_counts, sentiment_evolution, sentiment_daily, sentiment_weekly, sentiment_net_prev, sentiment_coverage_islands,
    sentiment_meta, sentiment_page, sentiment_sources, pending_anti_join, pending_count, actor_net_tone, actor_daily, confidence_normalised, model_distribution,
    lexicon_classify, retry_counts, answers_parsed, errors_cleared, retry_scan, term_coverage_drift,
)}

_TONED = f"{Q.ART}, {Q.TONE}, toned AS (SELECT art.*, sentimiento, procesado_en, modelo, confianza FROM art JOIN tone ON art.id = tone.id)"


def _wide(keys: str, source: str = "toned") -> str:
    n = lambda x: f"count(*) FILTER (WHERE sentimiento = '{x}')"
    return f"""SELECT {keys}, {n('positivo')} AS positivo, {n('neutral')} AS neutral, {n('negativo')} AS negativo, count(*) AS total,
      round(({n('positivo')} - {n('negativo')}) * 100.0::DOUBLE / count(*), 1) AS neto FROM {source} GROUP BY ALL"""


_NOW, _THEN = "fecha BETWEEN DATE '2026-03-12' AND DATE '2026-03-25'", "fecha BETWEEN DATE '2026-02-26' AND DATE '2026-03-11'"


def _f(cond: str, x: str = "") -> str:
    return f"count(*) FILTER (WHERE {cond}" + (f" AND sentimiento = '{x}')" if x else ")")


def _net(cond: str) -> str:
    return f"round_even(({_f(cond, 'positivo')} - {_f(cond, 'negativo')}) * 100.0::DOUBLE / nullif({_f(cond)}, 0), 0)::INTEGER"


ORACLE = {
    "current_tone": f"WITH {Q.TONE} SELECT id, sentimiento, procesado_en, modelo FROM tone",
    "sentiment_by_source": f"WITH {_TONED}, w AS ({_wide('fuente')}) SELECT * FROM w WHERE total >= 20 OR (SELECT max(total) FROM w) < 20",
    "sentiment_counts": f"WITH {_TONED} SELECT fuente, sentimiento, count(*) AS n FROM toned GROUP BY ALL",
    "sentiment_evolution": f"WITH {_TONED} {_wide('''CAST(date_trunc('month', fecha) AS DATE) AS mes''')}",
    "sentiment_daily": f"WITH {_TONED} SELECT fecha, sentimiento, count(*) AS n FROM toned GROUP BY ALL",
    "sentiment_weekly": f"WITH {_TONED} SELECT CAST(date_trunc('week', fecha) AS DATE) AS fecha_inicio, sentimiento, count(*) AS n_noticias FROM toned GROUP BY ALL",
    "sentiment_net_prev": f"""WITH {_TONED} SELECT *, neto - neto_previo AS delta, CASE WHEN neto <= -8 THEN 'neg' WHEN neto >= 8 THEN 'pos' ELSE 'neu' END AS clase FROM (
      SELECT {_f(_NOW, 'positivo')} AS positivo, {_f(_NOW, 'neutral')} AS neutral, {_f(_NOW, 'negativo')} AS negativo, {_f(_NOW)} AS total, coalesce({_net(_NOW)}, 0) AS neto, {_net(_THEN)} AS neto_previo FROM toned)""",
    "sentiment_coverage_islands": f"""WITH {_TONED}, m AS (SELECT CAST(date_trunc('month', fecha) AS DATE) AS mes, min(fecha) AS lo, max(fecha) AS hi FROM toned GROUP BY 1 HAVING count(*) >= {LEAST_MONTH}),
      i AS (SELECT *, datediff('month', mes, (SELECT max(mes) FROM m)) - row_number() OVER (ORDER BY mes DESC) AS isla FROM m)
      SELECT min(lo) AS desde, max(hi) AS hasta, count(*) AS meses FROM i WHERE isla = -1 HAVING count(*) > 0""",
    "sentiment_meta": f"WITH {Q.ART}, {Q.TONE} SELECT count(tone.id) AS clasificadas, count(*) AS total, round(avg(confianza))::INTEGER AS confianza, max(modelo) AS modelo FROM art LEFT JOIN tone ON art.id = tone.id",
    "sentiment_page": f"WITH {_TONED} SELECT id, titulo, fecha, sentimiento FROM toned WHERE fecha BETWEEN DATE '{START}' AND DATE '{END}' AND fuente = '{SOURCE}' AND sentimiento = 'negativo' ORDER BY fecha DESC, procesado_en DESC, id LIMIT 10",
    "sentiment_sources": f"WITH {_TONED} SELECT DISTINCT fuente FROM toned",
    "pending_anti_join": f"WITH {Q.ART} SELECT id, fecha FROM art WHERE length(titulo) >= 6 AND NOT EXISTS (SELECT 1 FROM noticias_sentimiento s WHERE s.id = art.id) ORDER BY fecha DESC NULLS LAST, id LIMIT 500",
    "pending_count": f"WITH {Q.ART} SELECT fuente, count(*) AS n FROM art WHERE length(titulo) >= 6 AND NOT EXISTS (SELECT 1 FROM noticias_sentimiento s WHERE s.id = art.id) GROUP BY fuente",
    "actor_net_tone": f"""WITH {_TONED}, a AS (SELECT t.actor AS actor, sentimiento FROM toned, unnest(list_distinct(regexp_extract_all(titulo, '{NAME}'))) AS t(actor)),
      w AS ({_wide('actor', 'a')}) SELECT actor, positivo, neutral, negativo, total, round(100.0::DOUBLE * positivo / total, 1) AS pct_pos, round(100.0::DOUBLE * negativo / total, 1) AS pct_neg,
      round(round(100.0::DOUBLE * positivo / total, 1) - round(100.0::DOUBLE * negativo / total, 1), 1) AS neto FROM w""",
    "actor_daily": f"""WITH {_TONED}, a AS (SELECT fecha, fuente, t.actor AS actor, sentimiento FROM toned, unnest(list_distinct(regexp_extract_all(titulo, '{NAME}'))) AS t(actor))
      SELECT fecha, fuente, actor, sentimiento, count(*) AS n FROM a GROUP BY ALL""",
    "confidence_normalised": """SELECT id, procesado_en, CASE WHEN r IS NOT NULL THEN greatest(0, least(100, round_even(CASE WHEN r > 1 THEN r ELSE r * 100 END, 0)::INTEGER)) END AS confianza_norm
      FROM (SELECT *, CASE WHEN confianza % 2 = 0 THEN confianza / 100.0::DOUBLE ELSE confianza::DOUBLE END AS r FROM noticias_sentimiento)""",
    "model_distribution": """SELECT modelo, prompt_version, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY procesado_en DESC NULLS LAST, lower(trim(sentimiento)) DESC, modelo DESC NULLS LAST, confianza DESC NULLS LAST, prompt_version DESC NULLS LAST) AS r
      FROM noticias_sentimiento WHERE id IS NOT NULL AND lower(trim(sentimiento)) IN ('positivo', 'neutral', 'negativo')) WHERE r = 1 GROUP BY ALL""",
    "retry_counts": f"""WITH {Q.TONE} SELECT s.id, (count(*) + CASE WHEN any_value(tone.id) IS NULL THEN 1 ELSE 0 END)::INTEGER AS intentos,
      CASE WHEN any_value(tone.id) IS NULL THEN TIMESTAMP '2026-04-01 00:00:00' ELSE max(s.procesado_en) END AS ultima_vez FROM noticias_sentimiento s LEFT JOIN tone ON s.id = tone.id GROUP BY s.id""",
    "answers_parsed": f"""WITH {Q.TONE}, t AS (SELECT id, sentimiento, (length(id) + ascii(id)) % 4 AS k FROM tone)
      SELECT id AS lote, 1::INTEGER AS numero, CASE WHEN k IN (0, 2) THEN sentimiento ELSE 'neutral' END AS sentimiento FROM t WHERE k < 3
      UNION ALL SELECT id, 2, CASE WHEN k = 1 THEN sentimiento ELSE 'neutral' END FROM t WHERE k < 3 UNION ALL SELECT id, NULL, NULL FROM t WHERE k = 3""",
    "errors_cleared": f"""WITH {Q.ART}, {Q.TONE}, old AS (SELECT id, count(*) AS intentos, max(procesado_en) AS ultima_vez FROM noticias_sentimiento WHERE id IS NOT NULL GROUP BY id),
      bad AS (SELECT id FROM art WHERE length(titulo) >= 6 AND NOT EXISTS (SELECT 1 FROM noticias_sentimiento s WHERE s.id = art.id))
      SELECT id, intentos::INTEGER AS intentos, ultima_vez FROM old WHERE NOT EXISTS (SELECT 1 FROM tone WHERE tone.id = old.id AND sentimiento = 'positivo')
      UNION ALL SELECT id, 1::INTEGER, TIMESTAMP '2026-04-01 00:00:00' FROM bad""",
    "retry_scan": f"""WITH {Q.ART}, old AS (SELECT id, count(*)::INTEGER AS intentos, max(procesado_en) AS ultima_vez FROM noticias_sentimiento WHERE id IS NOT NULL GROUP BY id)
      SELECT art.id, titulo, intentos, ultima_vez FROM art JOIN old ON art.id = old.id WHERE length(titulo) >= 6 ORDER BY ultima_vez NULLS FIRST, art.id LIMIT 500""",
    "lexicon_classify": f"""WITH {Q.ART}, t AS (SELECT id, regexp_extract_all(titulo, '[\\p{{L}}\\p{{M}}\\p{{N}}_]+') AS w FROM art WHERE length(titulo) > 5),
      c AS (SELECT id, len(list_filter(w, lambda x: regexp_matches(x, '^(?i)(inaugur|premi|celebr|rescat|estren|mejor|aprueb)'))) - len(list_filter(w, lambda x: regexp_matches(x, '^(?i)(muert|robo|incendi|estafa|condena|crisis$|azota|homicidi|rechaz)'))) AS d FROM t)
      SELECT id, CASE WHEN d > 0 THEN 'positivo' WHEN d < 0 THEN 'negativo' ELSE 'neutral' END AS sentimiento, 'lexicon' AS modelo FROM c""",
    "term_coverage_drift": f"""WITH {Q.ART} SELECT a.fecha, a.ahora, b.antes FROM (SELECT fecha, count(*)::INTEGER AS ahora FROM art GROUP BY fecha) a
      LEFT JOIN (SELECT fecha, count(*)::INTEGER AS antes FROM noticias GROUP BY fecha) b ON a.fecha = b.fecha WHERE antes IS NULL OR antes <> ahora""",
}
