"""Queries over links, pages and deliveries, made of the columns of ``noticias``."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from kiosko.functions import dates, text
from kiosko.functions import dictionaries as D
from kiosko.plans.common import read
from kiosko.queries import sql as Q
from kiosko.queries.titles import rows
from kiosko.sources import ingest, tables

TODAY = datetime.date(2026, 4, 1)


def _news(spark, d):
    return read(spark, d, "noticias")


def md5_ids(spark, d):
    return rows(spark, d).select("url", "fuente", ingest.article_id(F.col("url"), F.col("fuente")).alias("id_md5"))


def upsert_dedup(spark, d):
    """The deliveries as a raw batch: of each (url, fuente) the first by arrival."""
    raw = _news(spark, d).select("titulo", F.date_format("fecha", "dd/MM/yyyy").alias("fecha"), "url", "fuente", F.struct("created_at", "titulo", "fecha").alias("orden"))
    return ingest.prepared(raw, TODAY).select("id", "titulo", "fecha", "url", "fuente", "año")


def known_urls(spark, d):
    """URLs of the second half of the period that the first half doesn't know."""
    cut = datetime.date(2026, 3, 10)
    own = _news(spark, d)
    return ingest.unknown(own.where(F.col("fecha") >= F.lit(cut)).select("url").distinct(), own.where(F.col("fecha") < F.lit(cut)))


def date_parse_cascade(spark, d):
    """Dates written in each of the layouts, by the last digit of the day of the year."""
    own = rows(spark, d)
    kind = F.dayofyear("fecha") % 10
    layouts = ["yyyy-MM-dd", "yyyy/MM/dd", "yyyy M d", "dd-MM-yyyy", "dd/MM/yyyy", "d.M.yyyy", "dd-MM-yy", "dd/MM/yy", "d M yyyy", "d M yy"]
    written = F.coalesce(*[F.when(kind == i, F.date_format("fecha", x)) for i, x in enumerate(layouts)])
    return own.select("id", dates.parse_date(F.concat(F.lit(" "), written)).alias("fecha_leida"))


def url_dates(spark, d):
    return rows(spark, d).select("id", dates.url_date(F.col("url")).alias("fecha_url"))


def link_filter(spark, d):
    return ingest.wanted_links(_news(spark, d).select("url"), 60, keep=r"/[0-9]{8}/|/noticia/", drop=r"/video/|/autor/")


def link_absolute(spark, d):
    bare = F.regexp_replace("url", "^https?:", "")
    parts = F.when(F.length("url") % 3 == 0, bare).when(F.length("url") % 3 == 1, F.regexp_replace("url", "^https?://[^/]+", "")).otherwise(F.regexp_replace("url", "^https?://", "www."))
    return rows(spark, d).select("id", ingest.absolute(parts, "diario.example").alias("absoluta"))


def archived_urls(spark, d):
    lines = _news(spark, d).select(F.concat(F.regexp_replace("url", "^https", "http"), F.lit("?utm=1")).alias("value"))
    return ingest.archived_urls(lines, r"/[0-9]{8}/", r"/amp/")


def _pages(spark, d):
    own = rows(spark, d)
    body = F.concat(F.lit("<p class='x'>"), F.coalesce("bajada", F.lit("")), F.lit("</p><div>publicidad</div><p>"), "titulo", F.lit(" <b>fin</b></p>"))
    head = F.concat(F.lit("<title>"), "titulo", F.lit(" </title><meta property='article:published_time' content='"), F.col("fecha").cast("string"), F.lit("T10:00:00'>"))
    link = F.concat(F.lit("<a href='"), "url", F.lit("'>x</a><a href='/portada'>y</a><a href='"), "url", F.lit("'>z</a>"))
    return own.select(F.col("id").alias("page"), "url", F.concat(F.lit("<html><head>"), head, F.lit("</head><body>"), body, link, F.lit("</body></html>")).alias("html"))


def html_title_extract(spark, d):
    return _pages(spark, d).select("page", ingest.html_title(F.col("html")).alias("titulo_html"), F.substring(ingest.attribute(F.col("html"), "article:published_time"), 1, 10).alias("publicado"))


def html_paragraphs(spark, d):
    return _pages(spark, d).select("page", ingest.paragraphs(F.col("html")).alias("parrafos"))


def html_published(spark, d):
    return _pages(spark, d).select("page", ingest.published(F.col("html"), F.lit("https://x.example/nota")).alias("fecha_pagina"))


def html_links(spark, d):
    return ingest.links(_pages(spark, d))


def html_to_text(spark, d):
    """Of pages whose texts are escaped, as HTML has them."""
    safe = lambda c: F.replace(F.replace(F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&#62;"))
    own = rows(spark, d).where("titulo is not null")
    head, first, last = F.concat(F.lit("<head><style>p {color: red}</style><title>"), safe("titulo"), F.lit("</title></head>")), safe("bajada"), safe("titulo")
    html = F.concat(head, F.lit("<body><script>var x = '<p>no</p>';</script><p class='x'>"), first, F.lit("</p><div>uno<br>dos</div><ul><li>"), last, F.lit(" <b>fin</b></li></ul></body>"))
    return own.select(F.col("id").alias("page"), ingest.html_text(html).alias("texto"))


def backfill_verdicts(spark, d):
    """Pages dated two years back, on the day and a year ahead, judged against a floor and today."""
    own = rows(spark, d)
    shift = F.when(F.length("url") % 3 == 0, F.add_months("fecha", -24)).when(F.length("url") % 3 == 1, F.col("fecha")).otherwise(F.add_months("fecha", 12))
    pages = own.select("url", F.concat(F.lit("<html><meta content=\""), shift.cast("string"), F.lit("T08:00:00\" property='article:published_time'></html>")).alias("html"))
    known = own.where("fuente is null").select("url")
    return ingest.backfilled(pages.withColumn("url", F.concat(F.lit("https://x.example/"), F.translate(F.md5("url"), "0123456789", "ghijklmnop"))), known, datetime.date(2025, 1, 1), TODAY).select("url", "fecha", "veredicto")


def json_feed(spark, d):
    own = rows(spark, d)
    lines = own.select(F.to_json(F.struct(F.col("titulo").alias("post_title"), F.col("url").alias("post_URL"), F.concat(F.col("fecha").cast("string"), F.lit(" 08:00:00")).alias("raw_post_date"), F.lit("<p>uno</p><p>dos</p>").alias("post_content"))).alias("value"))
    return ingest.feed_articles(lines)


def body_clean(spark, d):
    return _news(spark, d).select("id", text.clean_body(F.col("cuerpo")).alias("limpio")).distinct()


def light_clean(spark, d):
    return _news(spark, d).select("id", text.light_clean(F.col("cuerpo")).alias("limpio")).distinct()


def pages_to_read(spark, d):
    last = rows(spark, d).groupBy("fuente").agg(F.max("fecha").alias("ultima"))
    return last.select("fuente", ingest.page_count(F.datediff(F.lit(TODAY), "ultima"), most=60).alias("paginas"))


def staging_checks(spark, d):
    return tables.checks(_news(spark, d), "titulo", "bajada", "cuerpo")


def coverage_snapshot(spark, d):
    return tables.coverage(rows(spark, d).where(F.trim("titulo") != ""), "ngramas")


def source_health(spark, d):
    runs = rows(spark, d).groupBy("fuente").agg(F.count("*").alias("filas"))
    runs = runs.withColumn("rc", F.when(F.col("filas") % 7 == 0, 1).otherwise(0)).withColumn("segundos", F.col("filas") * 3)
    return ingest.run_health(runs)


def month_labels(spark, d):
    return rows(spark, d).select("fecha").distinct().select("fecha", dates.month_label(F.col("fecha")).alias("etiqueta"), dates.week_start(F.col("fecha")).alias("domingo"))


def spanish_dates(spark, d):
    own = rows(spark, d)
    written = F.concat(F.lit("Publicado el "), dates.month_label(F.col("fecha")), F.lit(" de "), F.year("fecha").cast("string"), F.lit(" | 10:00"))
    return own.select("id", dates.spanish_date(written).alias("fecha_texto"))


QUERIES = {f.__name__: f for f in (
    md5_ids, upsert_dedup, known_urls, date_parse_cascade, url_dates, link_filter, link_absolute, archived_urls, html_title_extract, html_paragraphs,
    html_published, html_links, html_to_text, backfill_verdicts, json_feed, body_clean, light_clean, pages_to_read, staging_checks, coverage_snapshot, source_health,
    month_labels, spanish_dates,
)}

_MONTHS = "['enero','febrero','marzo','abril','mayo','junio','julio','agosto','septiembre','octubre','noviembre','diciembre'][month(fecha)]"
_CLEAN = Q.replaced(
    "lower(" + Q.replaced("cuerpo", (r"\{\{.*\}\}", ""), (r"\{.*\}", " "), (r"#[^\n]*[\p{L}\p{N}_]", " "), (r"var divElement.*\);", " "), (r"[\p{P}\p{S}]", " "), (r"\p{Nd}", " ")) + ")", (r"[\s\v\p{Z}]+", " ")
)

ORACLE = {
    "md5_ids": f"WITH {Q.ART} SELECT url, fuente, md5(url || '_' || fuente) AS id_md5 FROM art",
    "upsert_dedup": """SELECT md5(url || '_' || fuente) AS id, titulo, fecha, url, fuente, year(fecha)::INTEGER AS "año" FROM (
      SELECT *, row_number() OVER (PARTITION BY url, fuente ORDER BY created_at NULLS FIRST, titulo, fecha) AS r FROM noticias WHERE url <> '' AND fuente IS NOT NULL AND fecha IS NOT NULL) WHERE r = 1 AND titulo IS NOT NULL""",
    "known_urls": "SELECT DISTINCT url FROM noticias a WHERE fecha >= DATE '2026-03-10' AND NOT EXISTS (SELECT 1 FROM noticias b WHERE b.fecha < DATE '2026-03-10' AND b.url = a.url)",
    "date_parse_cascade": f"WITH {Q.ART} SELECT id, fecha AS fecha_leida FROM art",
    "url_dates": f"WITH {Q.ART} SELECT id, coalesce(" + ", ".join(
        f"CAST(try_strptime(nullif(regexp_extract(url, '{shape}', 1), ''), '{layout}') AS DATE)"
        for shape, layout in (("/([0-9]{4}/[0-9]{1,2}/[0-9]{1,2})", "%Y/%m/%d"), ("([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})", "%Y-%m-%d"), ("([0-9]{1,2}-[0-9]{1,2}-[0-9]{4})", "%d-%m-%Y"), ("([0-9]{8})", "%Y%m%d"))
    ) + ") AS fecha_url FROM art",
    "link_filter": "SELECT DISTINCT url FROM noticias WHERE length(url) > 60 AND regexp_matches(url, '/[0-9]{8}/|/noticia/') AND NOT regexp_matches(url, '/video/|/autor/')",
    "link_absolute": f"""WITH {Q.ART} SELECT id, CASE length(url) % 3 WHEN 0 THEN regexp_replace(url, '^http:', 'https:') WHEN 1 THEN regexp_replace(url, '^https?://[^/]+', 'https://diario.example')
      ELSE regexp_replace(url, '^https?://', 'https://www.') END AS absoluta FROM art""",
    "archived_urls": r"SELECT DISTINCT regexp_replace(regexp_replace(url, '\?.*$', ''), '^http:', 'https:') AS url FROM noticias WHERE regexp_matches(url, '/[0-9]{8}/') AND NOT regexp_matches(url, '/amp/')",
    "html_title_extract": f"WITH {Q.ART} SELECT id AS page, nullif(trim(titulo), '') AS titulo_html, fecha::VARCHAR AS publicado FROM art",
    "html_paragraphs": f"WITH {Q.ART} SELECT id AS page, trim(coalesce(bajada, '')) || chr(10) || trim(titulo || ' fin') AS parrafos FROM art",
    "html_published": f"WITH {Q.ART} SELECT id AS page, fecha AS fecha_pagina FROM art",
    "html_to_text": f"""WITH {Q.ART}, l AS (SELECT id AS page, [titulo, coalesce(bajada, ''), 'uno', 'dos', titulo || ' fin'] AS l FROM art WHERE titulo IS NOT NULL)
      SELECT page, array_to_string(list_filter(list_transform(l, lambda x: trim(regexp_replace(x, '[\\s\\p{{Z}}\\x{{85}}\\x{{1c}}-\\x{{1f}}\\v]+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS texto FROM l""",
    "html_links": f"WITH {Q.ART} SELECT id AS page, url FROM art UNION ALL SELECT id, '/portada' FROM art",
    "backfill_verdicts": f"""WITH {Q.ART}, p AS (SELECT 'https://x.example/' || translate(md5(url), '0123456789', 'ghijklmnop') AS url, CAST(CASE length(url) % 3 WHEN 0 THEN fecha - INTERVAL 24 MONTH WHEN 1 THEN fecha ELSE fecha + INTERVAL 12 MONTH END AS DATE) AS fecha FROM art)
      SELECT url, fecha, CASE WHEN fecha < DATE '2025-01-01' THEN 'fuera de rango' WHEN fecha > DATE '{TODAY}' + 1 THEN 'fecha futura' ELSE 'ok' END AS veredicto FROM p""",
    "json_feed": f"WITH {Q.ART} SELECT titulo, url, fecha::VARCHAR AS fecha, 'uno' || chr(10) || 'dos' AS cuerpo FROM art",
    "body_clean": f"""SELECT DISTINCT id, CASE WHEN trim(cuerpo) <> '' THEN array_to_string(list_filter(string_split(trim({_CLEAN}), ' '), lambda w: NOT list_contains({Q.listed(sorted(D.JUNK))}, w)), ' ') END AS limpio
      FROM noticias""",
    "light_clean": f"SELECT DISTINCT id, trim({Q.replaced('cuerpo', ('dfp:|[' + chr(92) + 'n' + chr(92) + 'r]', ' '), (r'[\s\v\p{Z}]+', ' '))}) AS limpio FROM noticias",
    "pages_to_read": f"WITH {Q.ART} SELECT fuente, greatest(2, least(ceil((DATE '{TODAY}' - max(fecha)) * 1.5), 60))::INTEGER AS paginas FROM art GROUP BY fuente",
    "staging_checks": "SELECT count(*) AS filas, " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulos, count(*) FILTER (WHERE length({c}) > 150) AS {c}_largos" for c in ("titulo", "bajada", "cuerpo")) + " FROM noticias",
    "coverage_snapshot": f"WITH {Q.ART} SELECT 'ngramas' AS analisis, fecha, count(*)::INTEGER AS n_noticias FROM art WHERE trim(titulo) <> '' GROUP BY fecha",
    "source_health": f"""WITH {Q.ART}, r AS (SELECT fuente, count(*) AS filas, CASE WHEN count(*) % 7 = 0 THEN 1 ELSE 0 END AS rc, count(*) * 3 AS segundos FROM art GROUP BY fuente)
      SELECT *, CASE WHEN rc = 124 OR segundos >= 300 THEN 'TIMEOUT' WHEN rc <> 0 THEN 'FALLO' WHEN filas = 0 THEN 'VACIO' WHEN segundos >= 240 THEN 'LENTO' ELSE 'OK' END AS salud FROM r""",
    "month_labels": f"WITH {Q.ART} SELECT DISTINCT fecha, day(fecha) || ' de ' || {_MONTHS} AS etiqueta, fecha - dayofweek(fecha)::INTEGER AS domingo FROM art",
    "spanish_dates": f"WITH {Q.ART} SELECT id, fecha AS fecha_texto FROM art",
}
