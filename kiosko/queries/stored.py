"""Tables that are written, changed and read again: each query makes a table in the shared folder."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from kiosko.operators import sentiment as S
from kiosko.plans.common import read, scratch, written
from kiosko.queries import sql as Q
from kiosko.queries.titles import rows
from kiosko.sources import ingest, tables
from kiosko.sources.vectors import VectorStore

CUT = datetime.date(2026, 3, 10)
TODAY = datetime.date(2026, 4, 1)


def _table(spark, name, date="fecha"):
    return tables.Table(spark, scratch(spark), tables.SCHEMAS[name], date)


def _daily(spark, d):
    return read(spark, d, "titulos_terminos_por_medio").where("termino is not null").groupBy("fecha", "termino").agg(F.sum("frecuencia").cast("int").alias("frecuencia"))


def table_upsert(spark, d):
    """The days up to a cut, then an upsert of the days from five before it on, with twice the counts."""
    t = _table(spark, "titulos_terminos_diarios")
    t.upsert(_daily(spark, d).where(F.col("fecha") <= F.lit(CUT)), "fecha", "termino")
    t.upsert(_daily(spark, d).where(F.col("fecha") >= F.lit(CUT - datetime.timedelta(days=5))).withColumn("frecuencia", F.col("frecuencia") * 2), "fecha", "termino")
    return t.read()


def table_insert_ignore(spark, d):
    """The same two batches, the second only where the key is new."""
    t = _table(spark, "titulos_terminos_diarios")
    t.append_new(_daily(spark, d).where(F.col("fecha") <= F.lit(CUT)), "fecha", "termino")
    t.append_new(_daily(spark, d).where(F.col("fecha") >= F.lit(CUT - datetime.timedelta(days=5))).withColumn("frecuencia", F.col("frecuencia") * 2), "fecha", "termino")
    return t.read()


def article_sink(spark, d):
    """Deliveries to ``noticias``, end to end: a first batch, then all of them with another ``bajada``; the upsert by id
    keeps the older day of arrival."""
    raw = read(spark, d, "noticias").select("titulo", F.date_format("fecha", "dd/MM/yyyy").alias("fecha"), "url", "fuente", "fecha_scraping", F.struct("created_at", "titulo", "fecha").alias("orden"))
    t = _table(spark, "noticias")
    first = ingest.prepared(raw.where(F.col("orden.fecha") <= F.lit(CUT)), TODAY)
    t.upsert(first.withColumn("fecha_scraping", F.lit(CUT)), "id")
    t.upsert(ingest.prepared(raw.withColumn("bajada", F.lit("nueva")), TODAY).withColumn("fecha_scraping", F.lit(TODAY)), "id", keep=("fecha_scraping",))
    return t.read().select("id", "titulo", "fecha", "fuente", "bajada", "fecha_scraping", "año")


def incremental_equals_full(spark, d):
    """Daily volumes of one run without the late articles, then of an incremental run from the first day that has
    drifted; the result is that of a full run."""
    own = written(rows(spark, d).select("id", "fecha", "fuente"))
    old = own.where(F.pmod(F.xxhash64("id"), F.lit(7)) > 0)
    full = lambda x: x.groupBy("fecha").agg(F.count("*").cast("int").alias("total_noticias"), F.countDistinct("fuente").cast("int").alias("terminos_unicos"), F.lit(None).cast("timestamp").alias("actualizado_en"))
    t = _table(spark, "metricas_titulos_diarias")
    t.overwrite(full(old))
    start = tables.start_date(own, tables.coverage(old, "volumen"))
    t.rewrite_from(full(own.where(F.col("fecha") >= F.lit(start))), start)
    return t.read().select("fecha", "total_noticias", F.col("terminos_unicos").alias("fuentes"))


def table_rebuild(spark, d):
    """A full rebuild over a table that held something else."""
    t = _table(spark, "titulos_terminos_diarios")
    t.overwrite(_daily(spark, d).withColumn("frecuencia", F.lit(0)))
    t.overwrite(_daily(spark, d).where(F.col("fecha") > F.lit(CUT)))
    return t.read()


def cascade_delete(spark, d):
    """Articles before a cut are deleted, and with them their results."""
    t = _table(spark, "noticias_sentimiento", None)
    t.overwrite(S.current(read(spark, d, "noticias_sentimiento")).select("id", "sentimiento", "modelo", F.col("procesado_en").cast("timestamp").alias("procesado_en"), "confianza", "prompt_version"))
    t.delete_with(rows(spark, d).where(F.col("fecha") < F.lit(CUT)), "id")
    return t.read().select("id", "sentimiento", "modelo")


def vector_store(spark, d):
    """Vectors inserted twice, then searched with every twentieth."""
    store = VectorStore(spark, scratch(spark))
    own = read(spark, d, "embeddings").select("vec_id", F.col("vec_id").cast("string").alias("origin"), F.lit("").alias("text"), "embedding")
    store.insert(own)
    store.insert(own)
    return store.search(own.where("vec_id % 20 = 0"), 0.3).select("a", "b", F.round("similitud", 4).alias("similitud"))


def resumed_run(spark, d):
    """A run over the pending articles that ends at a limit, and one that goes on; every article with a title has a
    result then."""
    t = _table(spark, "noticias_sentimiento", None)
    own = rows(spark, d)
    half = S.pending(own, t.read()).count() // 2
    S.run_pending(own, t, chunk=max(1, half), limit=max(1, half))
    S.run_pending(own, t, chunk=1 << 20)
    return t.read().groupBy("modelo").agg(F.count("*").alias("articulos"), F.countDistinct("id").alias("distintos"))


QUERIES = {f.__name__: f for f in (table_upsert, table_insert_ignore, article_sink, incremental_equals_full, table_rebuild, cascade_delete, vector_store, resumed_run)}

_DAILY = "d AS (SELECT fecha, termino, sum(frecuencia)::INTEGER AS frecuencia FROM titulos_terminos_por_medio WHERE termino IS NOT NULL GROUP BY ALL)"

ORACLE = {
    "table_upsert": f"WITH {_DAILY} SELECT fecha, termino, (CASE WHEN fecha >= DATE '{CUT}' - 5 THEN frecuencia * 2 ELSE frecuencia END)::INTEGER AS frecuencia FROM d",
    "table_insert_ignore": f"WITH {_DAILY} SELECT fecha, termino, (CASE WHEN fecha > DATE '{CUT}' THEN frecuencia * 2 ELSE frecuencia END)::INTEGER AS frecuencia FROM d",
    "article_sink": f"""SELECT md5(url || '_' || fuente) AS id, titulo, fecha, fuente, 'nueva' AS bajada, CASE WHEN fecha <= DATE '{CUT}' THEN DATE '{CUT}' ELSE DATE '{TODAY}' END AS fecha_scraping, year(fecha)::INTEGER AS "año" FROM (
      SELECT *, row_number() OVER (PARTITION BY url, fuente ORDER BY created_at NULLS FIRST, titulo, fecha) AS r FROM noticias WHERE url <> '' AND fuente IS NOT NULL AND fecha IS NOT NULL) WHERE r = 1 AND titulo IS NOT NULL""",
    "incremental_equals_full": f"WITH {Q.ART} SELECT fecha, count(*)::INTEGER AS total_noticias, count(DISTINCT fuente)::INTEGER AS fuentes FROM art GROUP BY fecha",
    "table_rebuild": f"WITH {_DAILY} SELECT * FROM d WHERE fecha > DATE '{CUT}'",
    "cascade_delete": f"WITH {Q.ART}, {Q.TONE} SELECT id, sentimiento, modelo FROM tone WHERE NOT EXISTS (SELECT 1 FROM art WHERE art.id = tone.id AND fecha < DATE '{CUT}')",
    "vector_store": """SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 4) AS similitud
      FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0 AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.3""",
    "resumed_run": f"WITH {Q.ART} SELECT 'lexicon' AS modelo, count(*) AS articulos, count(*) AS distintos FROM art WHERE length(titulo) >= 6",
}
