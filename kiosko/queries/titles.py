"""Queries over titles and the tables of their terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiosko.functions import dictionaries as D
from kiosko.functions import text as X
from kiosko.operators import network as N
from kiosko.operators import titles as O
from kiosko.operators.dashboard import between
from kiosko.plans.common import once, read, written
from kiosko.queries import sql as Q

DYNAMIC = 20  # occurrences from which an n-gram is a compound, in the test tables


def rows(spark: SparkSession, d: str, start=None, end=None, source: str | None = None) -> DataFrame:
    """The articles; those of a range of dates and a source, if one is given.  Rows of an article agree in both, so the
    conditions go to the scan, before articles are made of rows."""
    return O.articles(between(read(spark, d, "noticias"), start, end, source), "titulo", "fuente", "fecha", "url", "bajada")


def terms_daily(spark, d):
    return O.term_counts(O.article_terms(rows(spark, d)), "fecha")


def terms_by_source(spark, d):
    return O.term_counts(O.article_terms(rows(spark, d)), "fecha", "fuente")


def daily_metrics(spark, d):
    own = rows(spark, d)
    return O.daily_metrics(own, O.article_terms(own))


def top_terms(spark, d):
    return O.top(O.term_counts(O.article_terms(rows(spark, d))), "frecuencia", "termino", n=30)


def title_ngrams_daily(spark, d):
    return O.ngram_counts(O.article_ngrams(rows(spark, d)), "fecha")


def title_ngrams_by_source(spark, d):
    return O.ngram_counts(O.article_ngrams(rows(spark, d)), "fecha", "fuente")


def ngram_having(spark, d):
    return O.frequent_ngrams(read(spark, d, "titulos_ngramas_diarios"), DYNAMIC)


def compound_fusion(spark, d):
    own = O.with_title(rows(spark, d))
    toks = X.fused_by_regex(X.kept_tokens(X.tokens(X.term_profile(F.col("titulo")))), D.compounds())
    return own.select("id", F.array_join(toks, "|").alias("terminos"))


def canonical_terms(spark, d):
    own = O.with_title(rows(spark, d))
    return own.select("id", F.array_join(X.title_terms(F.col("titulo")), "|").alias("terminos"))


def dynamic_compounds(spark, d):
    return O.dynamic_compounds(read(spark, d, "titulos_ngramas_diarios"), DYNAMIC).select("patron", "etiqueta")


def terms_daily_dynamic(spark, d):
    found = O.dynamic_compounds(read(spark, d, "titulos_ngramas_diarios"), DYNAMIC)
    return O.term_counts(O.article_terms(rows(spark, d), found), "fecha")


def singular_words(spark, d):
    words = read(spark, d, "titulos_terminos_por_medio").select(F.lower(F.trim("termino")).alias("termino")).where("termino rlike '^[a-zñáéíóúü]+$'").distinct()
    return words.select("termino", X.singular(F.col("termino")).alias("singular"))


def cooc_pairs(spark, d):
    return O.pair_counts(rows(spark, d), "fecha", "fuente")


def _network(spark, d):
    return N.network(O.pair_counts(rows(spark, d), "fecha", "fuente"), sorted(D.STOPWORDS), threshold=5)


def cooc_network(spark, d):
    return _network(spark, d)


def louvain_communities(spark, d):
    return N.communities(_network(spark, d))


def louvain_validity(spark, d):
    """Whether the communities are a division of the network that is better than none: every node in one, modularity
    above that of a single community (0), and none merges with another to a higher one."""
    edges = written(_network(spark, d))
    found = written(N.communities(edges))
    row = N.modularity(edges, found).first()  # one row
    member = {r.termino: r.comunidad for r in found.collect()}  # at most twice the network's edges
    pairs = [(r.termino_a, r.termino_b) for r in edges.collect()]
    best = N.modularity_of(pairs, member)
    kinds = sorted(set(member.values()))
    better = sum(N.modularity_of(pairs, {t: a if c == b else c for t, c in member.items()}) > best + 1e-9 for i, a in enumerate(kinds) for b in kinds[i + 1 :])
    return spark.createDataFrame([(row.nodos, row.aristas, (row.modularidad or 0) > 0, abs(best - (row.modularidad or 0)) < 1e-5, better)], "nodos bigint, aristas bigint, mejor_que_una boolean, coincide boolean, uniones_mejores bigint")


def _terms(spark, d):
    return read(spark, d, "titulos_terminos_por_medio")


def _ngrams(spark, d):
    return read(spark, d, "titulos_ngramas_diarios")


def unified_terms_view(spark, d):
    daily = _terms(spark, d).groupBy("fecha", "termino").agg(F.sum("frecuencia").cast("int").alias("frecuencia"))
    return O.unified(daily, _ngrams(spark, d), "fecha")


def unified_by_source_view(spark, d):
    return O.unified(_terms(spark, d), O.ngram_counts(O.article_ngrams(rows(spark, d)), "fecha", "fuente"), "fecha", "fuente")


def monthly_rollup(spark, d):
    return O.monthly(_terms(spark, d))


def monthly_rollup_by_source(spark, d):
    return O.monthly(_terms(spark, d), "fuente")


def weekly_share(spark, d):
    return O.weekly_shares(_terms(spark, d))


def weekly_share_by_source(spark, d):
    return O.weekly_shares(_terms(spark, d), "fuente")


def tfidf_week(spark, d):
    return O.tfidf(_terms(spark, d))


def body_terms_daily(spark, d):
    own = O.articles(read(spark, d, "noticias"), "cuerpo_limpio", "fecha")
    toks = X.kept_tokens(X.tokens(F.lower("cuerpo_limpio")))
    return own.select("fecha", once(toks).alias("toks")).select("fecha", F.explode("toks").alias("termino")).groupBy("fecha", "termino").agg(F.count("*").cast("int").alias("frecuencia"))


def body_ngrams_daily(spark, d):
    own = O.articles(read(spark, d, "noticias"), "cuerpo_limpio", "fecha").withColumnRenamed("cuerpo_limpio", "titulo")
    return O.ngram_counts(O.article_ngrams(own), "fecha")


def clustered_top_terms(spark, d):
    """Top terms; near are those that meet the same others."""
    best = written(O.top(O.term_counts(O.article_terms(rows(spark, d))), "frecuencia", "termino", n=30))
    own = best.select("termino", F.col("frecuencia").cast("bigint").alias("total"))
    return N.clustered_top(N.with_profiles(own, O.pair_counts(rows(spark, d), "fecha", "fuente")))


def network_similarity(spark, d):
    return N.profile_similarity(written(_network(spark, d)))


def semantic_edges(spark, d):
    edges = written(_network(spark, d))
    return N.semantic_edges(N.profile_similarity(edges), edges, 0.3)


def cosine_pairs(spark, d):
    own = read(spark, d, "embeddings")
    found = N.similar(own.where("vec_id % 20 = 0"), own, 0.3)
    return found.select("a", "b", F.round("similitud", 4).alias("similitud"))


QUERIES = {f.__name__: f for f in (
    terms_daily, terms_by_source, daily_metrics, top_terms, title_ngrams_daily, title_ngrams_by_source, ngram_having, compound_fusion, canonical_terms,
    dynamic_compounds, terms_daily_dynamic, singular_words, cooc_pairs, cooc_network, louvain_communities, louvain_validity, unified_terms_view, unified_by_source_view,
    monthly_rollup, monthly_rollup_by_source, weekly_share, weekly_share_by_source, tfidf_week, body_terms_daily, body_ngrams_daily, clustered_top_terms, network_similarity, semantic_edges, cosine_pairs,
)}

_COUNT = "count(*)::INTEGER"


def _monthly(*keys: str) -> str:
    k = "".join(f", {x}" for x in keys)
    return f"SELECT CAST(date_trunc('month', fecha) AS DATE) AS fecha{k}, termino, sum(frecuencia)::BIGINT AS frecuencia FROM titulos_terminos_por_medio GROUP BY ALL"


def _weekly(*keys: str) -> str:
    k = "".join(f", {x}" for x in keys)
    return f"""SELECT week(fecha_inicio)::INTEGER AS semana, fecha_inicio{k}, termino, n, CAST(round(n::DOUBLE / sum(n) OVER (PARTITION BY fecha_inicio{k}), 6) AS DECIMAL(10,6)) AS p_semana
      FROM (SELECT CAST(date_trunc('week', fecha) AS DATE) AS fecha_inicio{k}, termino, sum(frecuencia)::BIGINT AS n FROM titulos_terminos_por_medio GROUP BY ALL)"""


def _body_grams() -> str:
    return Q.GRAMS.replace("min(titulo) AS titulo", "min(cuerpo_limpio) AS titulo")


_NETWORK = f"""{Q.PAIRS}, p AS (SELECT fecha, fuente, termino_a, termino_b, count(*) AS n FROM pair GROUP BY ALL),
      own AS (SELECT * FROM p WHERE termino_a NOT IN {Q.inside(sorted(D.STOPWORDS))} AND termino_b NOT IN {Q.inside(sorted(D.STOPWORDS))}),
      best AS (SELECT t FROM (SELECT termino_a AS t FROM own UNION ALL SELECT termino_b FROM own) GROUP BY t ORDER BY count(*) DESC, t LIMIT 50),
      edge AS (SELECT termino_a, termino_b, sum(n)::BIGINT AS peso FROM own WHERE termino_a IN (SELECT t FROM best) AND termino_b IN (SELECT t FROM best)
        GROUP BY termino_a, termino_b HAVING sum(n) >= 5 ORDER BY peso DESC, termino_a, termino_b LIMIT 500)"""
_SIMILAR = f"""{_NETWORK}, x AS (SELECT termino_a AS t, termino_b AS o, peso::DOUBLE AS w FROM edge UNION ALL SELECT termino_b, termino_a, peso FROM edge),
      s AS (SELECT t, sum(w * w) AS s FROM x GROUP BY t),
      sim AS (SELECT d.a AS termino_a, d.b AS termino_b, round(d.d / sqrt(sa.s * sb.s), 6) AS similitud FROM (SELECT a.t AS a, b.t AS b, sum(a.w * b.w) AS d FROM x a JOIN x b ON a.o = b.o AND a.t < b.t GROUP BY ALL) d
        JOIN s sa ON d.a = sa.t JOIN s sb ON d.b = sb.t)"""

_ENDINGS = sorted({" ".join(p[i:]) for p in D.compounds() for i in range(1, len(p))})
_SINGULAR = "CASE WHEN w LIKE '%ces' AND length(w) > 4 THEN left(w, -3) || 'z' WHEN w LIKE '%es' AND length(w) > 4 THEN left(w, -2) WHEN w LIKE '%s' AND length(w) > 3 THEN left(w, -1) ELSE w END"

_DYNAMIC = f"""g AS (SELECT ngrama, sum(n) AS total FROM titulos_ngramas_diarios WHERE tipo IN (2, 3) AND ngrama IS NOT NULL GROUP BY ngrama HAVING sum(n) >= {DYNAMIC}),
      l AS (SELECT ngrama, total, array_to_string(list_transform(string_split(ngrama, ' '), lambda w: {_SINGULAR}), ' ') AS etiqueta FROM g
        WHERE len(string_split(ngrama, ' ')) IN (2, 3) AND ngrama NOT IN {Q.inside(_ENDINGS)}),
      b AS (SELECT ngrama AS patron, etiqueta, total, ngrama, 0 AS k FROM l UNION ALL SELECT etiqueta, etiqueta, total, ngrama, 1 FROM l),
      dyn AS (SELECT patron, etiqueta FROM (SELECT *, row_number() OVER (PARTITION BY patron ORDER BY total DESC, ngrama, k, etiqueta) AS r FROM b) WHERE r = 1)"""
_CURATED = {" ".join(p): name for p, name in D.compounds().items()}

ORACLE = {
    "dynamic_compounds": f"WITH {_DYNAMIC} SELECT * FROM dyn",
    "terms_daily_dynamic": f"""WITH {Q.ART}, {_DYNAMIC}, cur AS (SELECT unnest({Q.listed(_CURATED)}) AS patron, unnest({Q.listed(_CURATED.values())}) AS etiqueta),
      pat AS (SELECT '<' || replace(patron, ' ', '><') || '>' AS m, etiqueta, len(string_split(patron, ' ')) AS n FROM (SELECT * FROM cur UNION ALL SELECT * FROM dyn WHERE patron NOT IN (SELECT patron FROM cur))),
      rx AS (SELECT string_agg(m, '|' ORDER BY n DESC, m) || '|<[^<>]*>' AS r, map(list(m ORDER BY m), list(etiqueta ORDER BY m)) AS names FROM pat),
      tok AS (SELECT fecha, {Q.canonical(Q.fused_by(Q.kept_tokens(Q.term_profile("titulo")), "rx.r", "rx.names"))} AS toks FROM art, rx WHERE trim(titulo) <> ''),
      term AS (SELECT fecha, t.termino AS termino FROM tok, unnest(toks) AS t(termino) WHERE length(t.termino) <= 150)
      SELECT fecha, termino, {_COUNT} AS frecuencia FROM term GROUP BY ALL""",
    "louvain_validity": f"WITH {_NETWORK} SELECT (SELECT count(DISTINCT t) FROM (SELECT termino_a AS t FROM edge UNION ALL SELECT termino_b FROM edge)) AS nodos, count(*) AS aristas, true AS mejor_que_una, true AS coincide, 0::BIGINT AS uniones_mejores FROM edge",
    "network_similarity": f"WITH {_SIMILAR} SELECT * FROM sim",
    "semantic_edges": f"WITH {_SIMILAR} SELECT * FROM sim WHERE similitud >= 0.3 AND NOT EXISTS (SELECT 1 FROM edge WHERE least(edge.termino_a, edge.termino_b) = sim.termino_a AND greatest(edge.termino_a, edge.termino_b) = sim.termino_b)",
    "terms_daily": f"WITH {Q.TERMS} SELECT fecha, termino, {_COUNT} AS frecuencia FROM term GROUP BY ALL",
    "terms_by_source": f"WITH {Q.TERMS} SELECT fecha, fuente, termino, {_COUNT} AS frecuencia FROM term GROUP BY ALL",
    "daily_metrics": f"""WITH {Q.TERMS} SELECT a.fecha, a.total_noticias, coalesce(b.n, 0)::INTEGER AS terminos_unicos FROM
      (SELECT fecha, {_COUNT} AS total_noticias FROM art GROUP BY fecha) a LEFT JOIN (SELECT fecha, count(DISTINCT termino) AS n FROM term GROUP BY fecha) b ON a.fecha = b.fecha""",
    "top_terms": f"WITH {Q.TERMS} SELECT termino, {_COUNT} AS frecuencia FROM term GROUP BY termino ORDER BY 2 DESC, 1 LIMIT 30",
    "title_ngrams_daily": f"WITH {Q.GRAMS} SELECT fecha, ngrama, tipo::SMALLINT AS tipo, {_COUNT} AS n FROM gram GROUP BY ALL",
    "title_ngrams_by_source": f"WITH {Q.GRAMS} SELECT fecha, fuente, ngrama, tipo::SMALLINT AS tipo, {_COUNT} AS n FROM gram GROUP BY ALL",
    "ngram_having": f"SELECT ngrama, sum(n)::BIGINT AS total FROM titulos_ngramas_diarios WHERE tipo IN (2, 3) AND ngrama IS NOT NULL GROUP BY ngrama HAVING sum(n) >= {DYNAMIC}",
    "compound_fusion": f"WITH {Q.ART} SELECT id, array_to_string({Q.fused(Q.kept_tokens(Q.term_profile('titulo')), D.compounds())}, '|') AS terminos FROM art WHERE trim(titulo) <> ''",
    "canonical_terms": f"WITH {Q.ART} SELECT id, array_to_string({Q.terms('titulo')}, '|') AS terminos FROM art WHERE trim(titulo) <> ''",
    "singular_words": """SELECT termino, CASE WHEN termino LIKE '%ces' AND length(termino) > 4 THEN left(termino, -3) || 'z' WHEN termino LIKE '%es' AND length(termino) > 4 THEN left(termino, -2)
      WHEN termino LIKE '%s' AND length(termino) > 3 THEN left(termino, -1) ELSE termino END AS singular
      FROM (SELECT DISTINCT lower(trim(termino)) AS termino FROM titulos_terminos_por_medio) WHERE regexp_full_match(termino, '[a-zñáéíóúü]+')""",
    "cooc_pairs": f"WITH {Q.PAIRS} SELECT fecha, fuente, termino_a, termino_b, {_COUNT} AS n FROM pair GROUP BY ALL",
    "cooc_network": f"""WITH {Q.PAIRS}, p AS (SELECT fecha, fuente, termino_a, termino_b, count(*) AS n FROM pair GROUP BY ALL),
      own AS (SELECT * FROM p WHERE termino_a NOT IN {Q.inside(sorted(D.STOPWORDS))} AND termino_b NOT IN {Q.inside(sorted(D.STOPWORDS))}),
      best AS (SELECT t FROM (SELECT termino_a AS t FROM own UNION ALL SELECT termino_b FROM own) GROUP BY t ORDER BY count(*) DESC, t LIMIT 50)
      SELECT termino_a, termino_b, sum(n)::BIGINT AS peso FROM own WHERE termino_a IN (SELECT t FROM best) AND termino_b IN (SELECT t FROM best)
      GROUP BY termino_a, termino_b HAVING sum(n) >= 5 ORDER BY peso DESC, termino_a, termino_b LIMIT 500""",
    "unified_terms_view": """SELECT fecha, termino, sum(frecuencia)::INTEGER AS frecuencia, 1::SMALLINT AS tipo FROM titulos_terminos_por_medio GROUP BY fecha, termino
      UNION ALL SELECT fecha, ngrama, n, tipo FROM titulos_ngramas_diarios""",
    "unified_by_source_view": f"""WITH {Q.GRAMS} SELECT fecha, fuente, termino, frecuencia, 1::SMALLINT AS tipo FROM titulos_terminos_por_medio
      UNION ALL SELECT fecha, fuente, ngrama, {_COUNT}, tipo::SMALLINT FROM gram GROUP BY fecha, fuente, ngrama, tipo""",
    "monthly_rollup": _monthly(),
    "monthly_rollup_by_source": _monthly("fuente"),
    "weekly_share": _weekly(),
    "weekly_share_by_source": _weekly("fuente"),
    "tfidf_week": """WITH b AS (SELECT CAST(date_trunc('week', fecha) AS DATE) AS fecha_semana, fuente, termino, sum(frecuencia) AS n FROM titulos_terminos_por_medio GROUP BY ALL),
      t AS (SELECT fecha_semana, fuente, sum(n) AS t FROM b GROUP BY ALL), s AS (SELECT fecha_semana, count(*) AS s FROM t GROUP BY ALL),
      f AS (SELECT fecha_semana, termino, count(*) AS df FROM b GROUP BY ALL)
      SELECT b.fecha_semana, b.fuente, b.termino, round(n::DOUBLE / t * ln(s::DOUBLE / df), 6) AS tfidf FROM b JOIN t ON b.fecha_semana = t.fecha_semana AND b.fuente = t.fuente
      JOIN s ON b.fecha_semana = s.fecha_semana JOIN f ON b.fecha_semana = f.fecha_semana AND b.termino = f.termino""",
    "body_terms_daily": f"""SELECT fecha, t.termino AS termino, {_COUNT} AS frecuencia FROM (SELECT id, min(fecha) AS fecha, min(cuerpo_limpio) AS c FROM noticias WHERE id IS NOT NULL GROUP BY id),
      unnest({Q.kept_tokens('lower(c)')}) AS t(termino) GROUP BY ALL""",
    "body_ngrams_daily": f"WITH {_body_grams()} SELECT fecha, ngrama, tipo::SMALLINT AS tipo, {_COUNT} AS n FROM gram GROUP BY ALL",
    "cosine_pairs": """SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 4) AS similitud
      FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0 AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.3""",
}
