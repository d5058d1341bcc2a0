"""The questions of the dashboard over the test tables."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from kiosko.functions import dictionaries as D
from kiosko.operators import dashboard as B
from kiosko.operators import titles as O
from kiosko.plans import router
from kiosko.plans.common import read
from kiosko.queries import sql as Q
from kiosko.queries.titles import rows

START, END = datetime.date(2026, 2, 25), datetime.date(2026, 3, 25)
SOURCE = "diariocoiron"
LEMMA = "elección"
WORDS = ["hospital", "escuela", "senado"]
COMMON = ["País", "villa", "quebrada"]
KNOWN = {SOURCE: "Captura interrumpida por el sitio."}
STATEMENTS = ["Consulta: SELECT id FROM noticias -- ", "SELECT created_at FROM noticias -- ", "drop table noticias -- ", "select fecha from noticias limit 5 -- "]
GAP = 2  # days from which a gap or inactivity is reported in the test tables


def _terms(spark, d):
    return read(spark, d, "titulos_terminos_por_medio")


def _news(spark, d):
    return read(spark, d, "noticias")


def _with_word(spark, d, word):
    """Articles of the range with a word in the title."""
    return O.articles(B.titles_with_word(B.between(_news(spark, d), START, END), word), "titulo", "fuente", "fecha", "url")


def date_range(spark, d):
    return rows(spark, d).agg(F.min("fecha").alias("desde"), F.max("fecha").alias("hasta"), F.countDistinct("fuente").alias("fuentes"))


def corpus_size(spark, d):
    own = rows(spark, d)
    return own.agg(F.count("*").alias("articulos"), F.year(F.min("fecha")).alias("primer_anio"), F.round(F.floor(F.count("*") / 100) / 10, 1).alias("miles"))


def distinct_terms(spark, d):
    own = B.between(_terms(spark, d), START, END).where(~F.col("termino").isin(sorted(D.STOPWORDS)))
    return own.agg(F.countDistinct("termino").alias("terminos"))


def top_terms_10(spark, d):
    own = B.between(_terms(spark, d), START, END)
    return O.top(B.term_totals(own, B.excluded(D.STOPWORDS, "villa, Quebrada")), "total", "termino", n=10)


def top_terms_source(spark, d):
    own = B.between(_terms(spark, d), START, END, SOURCE)
    return O.top(B.term_totals(own, sorted(D.STOPWORDS)), "total", "termino", n=25)


def top_term_per_source(spark, d):
    totals = _terms(spark, d).where(F.trim("termino") != "").groupBy("fuente", "termino").agg(F.sum("frecuencia").alias("total"))
    return O.top_per_group(totals, "fuente", "total", "termino", n=3)


def routed_top_terms(spark, d):
    """By the table that the range asks for: here the daily one, for it is short."""
    table = router.term_table(START, END)
    own = O.monthly(_terms(spark, d)) if table.startswith("mv_") else _terms(spark, d)
    return O.top(B.term_totals(B.between(own, START, END), sorted(D.STOPWORDS)), "total", "termino", n=30)


def evolution_terms(spark, d):
    return B.series(B.between(_terms(spark, d), START, END), WORDS)


def evolution_lemma(spark, d):
    """The course of a word in all its forms (the lemma map turned about), under the one name."""
    own = B.series(B.between(_terms(spark, d), START, END), D.variants(LEMMA))
    return own.groupBy("fecha").agg(F.sum("frecuencia").alias("frecuencia")).select("fecha", F.lit(LEMMA).alias("termino"), "frecuencia")


def evolution_source(spark, d):
    return B.series(B.between(_terms(spark, d), START, END, SOURCE), COMMON)


def evolution_yearly(spark, d):
    return B.yearly(B.series(_terms(spark, d), WORDS), "frecuencia", "termino")


def volume_day(spark, d):
    return B.volume(rows(spark, d, START, END), "fecha")


def volume_summary(spark, d):
    return B.volume_summary(B.volume(rows(spark, d, START, END), "fecha"))


def volume_period_source(spark, d):
    period = F.to_date(F.date_trunc(router.granularity(START, END + datetime.timedelta(days=300)), F.col("fecha"))).alias("periodo")
    return B.volume(rows(spark, d), period, "fuente")


def source_totals(spark, d):
    return O.top(B.volume(rows(spark, d), "fuente"), "n", "fuente", n=10)


def source_share_by_year(spark, d):
    return B.volume(rows(spark, d), F.year("fecha").alias("anio"), "fuente").withColumnRenamed("n", "articulos")


def term_search_prefix(spark, d):
    return B.prefix_search(_terms(spark, d), "hosp")


def term_search_stems(spark, d):
    found = [(r.termino, r.total) for r in B.prefix_search(_terms(spark, d), "es").collect()]  # at most 20 rows
    return spark.createDataFrame(B.first_per_stem(found), "termino string, total bigint")


def title_search_word(spark, d):
    """Titles agree in all rows of an article, so they are searched before articles are made of rows."""
    own = B.titles_with_word(_news(spark, d), "según")
    return O.articles(own, "titulo", "fecha")


def title_search_any(spark, d):
    own = rows(spark, d)
    return own.where(F.exists(F.split(F.lower("titulo"), " "), lambda w: w.isin(WORDS))).select("id", "fuente")


def news_page(spark, d):
    own = _with_word(spark, d, "en")
    return B.page(own, 3, 5, F.desc("fecha"), "id").select("id", "titulo", "fuente", "fecha", "url")


def news_page_ascending(spark, d):
    own = rows(spark, d, START, END, SOURCE)
    return B.page(own, 2, 5, "fecha", "id").select("id", "titulo", "fuente", "fecha")


def news_count(spark, d):
    own = _with_word(spark, d, "en").agg(F.count("*").alias("total"))
    return own.withColumn("paginas", F.greatest(F.lit(1), F.ceil(F.col("total") / 5)).cast("int"))


def concept_by_source_dense(spark, d):
    own = B.between(_terms(spark, d), START, END)
    return B.dense(own, "fuente", "termino", "frecuencia", WORDS)


def gap_diagnostics(spark, d):
    return B.gaps(rows(spark, d))


def source_status(spark, d):
    return B.source_status(B.gaps(rows(spark, d)), END + datetime.timedelta(days=3), GAP, KNOWN)


def source_labels(spark, d):
    """The sources of the articles, and those that have a label of their own."""
    own = rows(spark, d).select("fuente").distinct()
    all_of_them = own.unionByName(spark.createDataFrame([(x,) for x in D.SOURCE_LABELS], "fuente string"))
    return all_of_them.distinct().select("fuente", B.source_label(F.col("fuente")).alias("nombre"))


def routed_monthly_terms(spark, d):
    """The same over a range that asks for the monthly table."""
    start = END - datetime.timedelta(days=200)
    assert router.term_table(start, END) == "mv_terminos_mensuales"
    own = B.between(O.monthly(_terms(spark, d)), start, END)
    return O.top(B.term_totals(own, sorted(D.STOPWORDS)), "total", "termino", n=30)


def all_term_totals(spark, d):
    """Totals over the whole table, without a range."""
    return B.term_totals(_terms(spark, d), sorted(D.STOPWORDS))


def guarded_sql(spark, d):
    """Generated statements about each source, some of which change data, some without a limit."""
    own = rows(spark, d).select("fuente").distinct()
    text = F.explode(F.array(*[F.concat(F.lit("```sql\n" + k), F.col("fuente"), F.lit("```")) for k in STATEMENTS]))
    return own.select("fuente", text.alias("respuesta")).select("fuente", "respuesta", router.guarded_column(F.col("respuesta")).alias("sql"))


def clamped_range(spark, d):
    """The range that is asked, within the dates that there are."""
    last = rows(spark, d).agg(F.max("fecha")).first()[0]  # one row
    found = router.clamped(datetime.date(2010, 1, 1), datetime.date(2100, 1, 1), last, END)
    return spark.createDataFrame([(*found, router.granularity(*found))] if found else [], "desde date, hasta date, detalle string")


def last_dates(spark, d):
    return rows(spark, d).groupBy("fuente").agg(F.max("fecha").alias("ultima"), F.min("fecha").alias("primera"))


def recent_articles(spark, d):
    """Of the last seven days before a stated day, future dates left out."""
    return rows(spark, d, END - datetime.timedelta(days=7), END).select("id", "fecha")


QUERIES = {f.__name__: f for f in (
    date_range, corpus_size, distinct_terms, top_terms_10, top_terms_source, top_term_per_source, routed_top_terms, evolution_terms, evolution_lemma, evolution_source,
    evolution_yearly, volume_day, volume_summary, volume_period_source, source_totals, source_share_by_year, term_search_prefix, term_search_stems,
    title_search_word, title_search_any, news_page, news_page_ascending, news_count, concept_by_source_dense, gap_diagnostics, source_status, last_dates,
    recent_articles, source_labels, routed_monthly_terms, all_term_totals, guarded_sql, clamped_range,
)}

_T = "titulos_terminos_por_medio"
_IN = f"fecha BETWEEN DATE '{START}' AND DATE '{END}'"
_IDLE = f"(DATE '{END + datetime.timedelta(days=3)}' - ultima)"
_STOP = Q.inside(sorted(D.STOPWORDS))
_EN = r"regexp_matches(titulo, '(?i)(^|[^\p{L}\p{N}_])en($|[^\p{L}\p{N}_])')"
_GAPS = f"""{Q.ART}, days AS (SELECT DISTINCT fuente, fecha FROM art WHERE fuente IS NOT NULL AND fecha IS NOT NULL),
  p AS (SELECT fuente, fecha, lag(fecha) OVER (PARTITION BY fuente ORDER BY fecha) AS prev FROM days),
  g AS (SELECT *, row_number() OVER (PARTITION BY fuente ORDER BY fecha - prev DESC, fecha) AS r FROM p WHERE prev IS NOT NULL),
  u AS (SELECT fuente, max(fecha) AS ultima FROM days GROUP BY fuente),
  gaps AS (SELECT u.fuente, coalesce(g.fecha - g.prev - 1, 0)::INTEGER AS gap_dias, g.prev + 1 AS gap_desde, g.fecha - 1 AS gap_hasta, ultima FROM u LEFT JOIN g ON u.fuente = g.fuente AND g.r = 1)"""


def _series(cond: str, words: list[str] = WORDS) -> str:
    return f"SELECT fecha, termino, sum(frecuencia)::BIGINT AS frecuencia FROM {_T} WHERE lower(termino) IN {Q.inside(w.lower() for w in words)} AND {cond} GROUP BY ALL"


ORACLE = {
    "date_range": f"WITH {Q.ART} SELECT min(fecha) AS desde, max(fecha) AS hasta, count(DISTINCT fuente) AS fuentes FROM art",
    "corpus_size": f"WITH {Q.ART} SELECT count(*) AS articulos, year(min(fecha))::INTEGER AS primer_anio, round(floor(count(*) / 100) / 10, 1) AS miles FROM art",
    "distinct_terms": f"SELECT count(DISTINCT termino) AS terminos FROM {_T} WHERE {_IN} AND termino NOT IN {_STOP}",
    "top_terms_10": f"SELECT termino, sum(frecuencia)::BIGINT AS total FROM {_T} WHERE {_IN} AND termino NOT IN {_STOP} AND termino NOT IN ('villa', 'quebrada') GROUP BY termino ORDER BY 2 DESC, 1 LIMIT 10",
    "top_terms_source": f"SELECT termino, sum(frecuencia)::BIGINT AS total FROM {_T} WHERE {_IN} AND fuente = '{SOURCE}' AND termino NOT IN {_STOP} GROUP BY termino ORDER BY 2 DESC, 1 LIMIT 25",
    "top_term_per_source": f"""SELECT fuente, termino, total FROM (SELECT fuente, termino, sum(frecuencia)::BIGINT AS total, row_number() OVER (PARTITION BY fuente ORDER BY sum(frecuencia) DESC, termino) AS r
      FROM {_T} WHERE trim(termino) <> '' GROUP BY fuente, termino) WHERE r <= 3""",
    "routed_top_terms": f"SELECT termino, sum(frecuencia)::BIGINT AS total FROM {_T} WHERE {_IN} AND termino NOT IN {_STOP} GROUP BY termino ORDER BY 2 DESC, 1 LIMIT 30",
    "evolution_terms": _series(_IN),
    "evolution_lemma": f"SELECT fecha, '{LEMMA}' AS termino, sum(frecuencia)::BIGINT AS frecuencia FROM {_T} WHERE lower(termino) IN ('elección', 'elecciones', 'electoral', 'electorales') AND {_IN} GROUP BY fecha",
    "evolution_source": _series(f"{_IN} AND fuente = '{SOURCE}'", COMMON),
    "evolution_yearly": f"SELECT year(fecha)::INTEGER AS anio, termino, sum(frecuencia)::BIGINT AS frecuencia FROM {_T} WHERE lower(termino) IN {Q.inside(WORDS)} GROUP BY ALL",
    "volume_day": f"WITH {Q.ART} SELECT fecha, count(*) AS n FROM art WHERE {_IN} GROUP BY fecha",
    "volume_summary": f"WITH {Q.ART} SELECT sum(n)::BIGINT AS total, count(*) AS dias, round(avg(n), 1) AS media FROM (SELECT fecha, count(*) AS n FROM art WHERE {_IN} GROUP BY fecha)",
    "volume_period_source": f"WITH {Q.ART} SELECT CAST(date_trunc('month', fecha) AS DATE) AS periodo, fuente, count(*) AS n FROM art GROUP BY ALL",
    "source_totals": f"WITH {Q.ART} SELECT fuente, count(*) AS n FROM art GROUP BY fuente ORDER BY 2 DESC, 1 LIMIT 10",
    "source_share_by_year": f"WITH {Q.ART} SELECT year(fecha)::INTEGER AS anio, fuente, count(*) AS articulos FROM art GROUP BY ALL",
    "term_search_prefix": f"SELECT termino, sum(frecuencia)::BIGINT AS total FROM {_T} WHERE termino ILIKE 'hosp%' GROUP BY termino ORDER BY CASE WHEN lower(termino) = 'hosp' THEN 0 ELSE 1 END, 2 DESC, 1 LIMIT 20",
    "title_search_word": rf"WITH {Q.ART} SELECT id, titulo, fecha FROM art WHERE regexp_matches(titulo, '(?i)(^|[^\p{{L}}\p{{N}}_])según($|[^\p{{L}}\p{{N}}_])')",
    "title_search_any": f"WITH {Q.ART} SELECT id, fuente FROM art WHERE len(list_filter(string_split(lower(titulo), ' '), lambda w: w IN {Q.inside(WORDS)})) > 0",
    "news_page": f"WITH {Q.ART} SELECT id, titulo, fuente, fecha, url FROM art WHERE {_IN} AND {_EN} ORDER BY fecha DESC, id LIMIT 5 OFFSET 10",
    "news_page_ascending": f"WITH {Q.ART} SELECT id, titulo, fuente, fecha FROM art WHERE {_IN} AND fuente = '{SOURCE}' ORDER BY fecha, id LIMIT 5 OFFSET 5",
    "news_count": f"WITH {Q.ART} SELECT count(*) AS total, greatest(1, ceil(count(*) / 5.0))::INTEGER AS paginas FROM art WHERE {_IN} AND {_EN}",
    "concept_by_source_dense": f"""SELECT s.fuente, w.termino, coalesce(sum(frecuencia), 0)::BIGINT AS frecuencia FROM (SELECT DISTINCT fuente FROM {_T} WHERE {_IN}) s
      CROSS JOIN (SELECT unnest({Q.listed(WORDS)}) AS termino) w LEFT JOIN (SELECT * FROM {_T} WHERE {_IN}) t ON t.fuente = s.fuente AND t.termino = w.termino GROUP BY ALL""",
    "gap_diagnostics": f"WITH {_GAPS} SELECT * FROM gaps",
    "source_status": f"""WITH {_GAPS} SELECT *, (DATE '{END + datetime.timedelta(days=3)}' - ultima)::INTEGER AS dias_inactivo,
      CASE WHEN fuente = '{SOURCE}' OR {_IDLE} >= {GAP} THEN 'malo' WHEN gap_dias >= {GAP} THEN 'gap' ELSE 'ok' END AS estado,
      CASE WHEN fuente = '{SOURCE}' THEN '⛔ ' || '{KNOWN[SOURCE]}' WHEN {_IDLE} >= {GAP} THEN '⛔ Inactivo: sin noticias desde el ' || strftime(ultima, '%d-%m-%Y') || '.'
        WHEN gap_dias >= {GAP} THEN '⚠ Gap de datos: sin noticias del ' || strftime(gap_desde, '%d-%m-%Y') || ' al ' || strftime(gap_hasta, '%d-%m-%Y') || ' (' || gap_dias || ' días).' ELSE '' END AS problema FROM gaps""",
    "source_labels": f"""WITH {Q.ART} SELECT fuente, coalesce(nombre, fuente) AS nombre FROM (SELECT DISTINCT fuente FROM art UNION SELECT unnest({Q.listed(D.SOURCE_LABELS)}))
      LEFT JOIN (SELECT unnest({Q.listed(D.SOURCE_LABELS)}) AS f, unnest({Q.listed(D.SOURCE_LABELS.values())}) AS nombre) ON fuente = f""",
    "routed_monthly_terms": f"""SELECT termino, sum(frecuencia)::BIGINT AS total FROM {_T} WHERE date_trunc('month', fecha) BETWEEN DATE '{END}' - 200 AND DATE '{END}' AND termino NOT IN {_STOP}
      GROUP BY termino ORDER BY 2 DESC, 1 LIMIT 30""",
    "all_term_totals": f"SELECT termino, sum(frecuencia)::BIGINT AS total FROM {_T} WHERE termino NOT IN {_STOP} GROUP BY termino",
    "guarded_sql": f"""WITH {Q.ART}, s AS (SELECT DISTINCT fuente FROM art), k AS (SELECT unnest({Q.listed(STATEMENTS)}) AS k)
      SELECT fuente, '```sql' || chr(10) || k || fuente || '```' AS respuesta, CASE WHEN k LIKE 'Consulta%' THEN substr(k, 11) || fuente || ' LIMIT 30' WHEN k LIKE 'select%' THEN k || fuente END AS sql FROM s, k""",
    "clamped_range": f"WITH {Q.ART} SELECT DATE '2018-01-01' AS desde, least(max(fecha), DATE '{END}') AS hasta, 'year' AS detalle FROM art",
    "last_dates": f"WITH {Q.ART} SELECT fuente, max(fecha) AS ultima, min(fecha) AS primera FROM art GROUP BY fuente",
    "recent_articles": f"WITH {Q.ART} SELECT id, fecha FROM art WHERE fecha BETWEEN DATE '{END}' - 7 AND DATE '{END}'",
}
