"""Aggregates of titles: terms, n-grams, pairs, and what is derived from their tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiosko.functions import dictionaries as D
from kiosko.functions import text as X
from kiosko.plans.common import once, written


def articles(noticias: DataFrame, *columns: str) -> DataFrame:
    """One row per article: ``id`` and ``columns``.  Rows of an article agree but for their arrival; the least value is
    taken where they don't, and combined before the shuffle.  Null ids are left out."""
    return noticias.where(F.col("id").isNotNull()).groupBy("id").agg(*(F.min(c).alias(c) for c in columns))


def with_title(rows: DataFrame) -> DataFrame:
    return rows.where(F.trim("titulo") != "")


def article_terms(rows: DataFrame, dynamic: DataFrame | None = None, longest: int = 150, most: int = 200_000) -> DataFrame:
    """One row per term of a title, repeats kept: the columns of ``rows`` and ``termino``.

    With ``dynamic`` compounds (patron, etiqueta, total) the fusion uses curated and dynamic patterns together, the curated
    ones first: by a broadcast dictionary if there are at most ``most``, else by a join of the titles' word sequences with
    the patterns.  Without, the curated ones alone, in the JVM.
    """
    rows = with_title(rows)
    if dynamic is not None:
        curated = D.compounds()
        spark = rows.sparkSession
        fixed = spark.createDataFrame([(" ".join(p), name) for p, name in curated.items()], "patron string, etiqueta string").withColumn("total", F.lit(0).cast("bigint"))
        dynamic = written(dynamic.where(~F.col("patron").isin([" ".join(p) for p in curated])).select("patron", "etiqueta", "total"))
        rows = rows.withColumn("_t", X.kept_tokens(X.tokens(X.term_profile(F.col("titulo")))))
        found = dynamic.limit(most + 1).collect() if most else [None]
        if len(found) <= most:
            rows = X.fused_by_dictionary(rows, "_t", {**curated, **{tuple(r.patron.split(" ")): r.etiqueta for r in found}})
        else:
            rows = X.fused_by_table(rows, "_t", written(dynamic.unionByName(fixed)))
        rows = rows.withColumn("_t", once(X.canonical_terms(F.col("_t"))))
    else:
        rows = rows.withColumn("_t", once(X.title_terms(F.col("titulo"))))
    return rows.withColumn("termino", F.explode("_t")).drop("_t").where(F.length("termino") <= longest)


def term_counts(terms: DataFrame, *keys: str) -> DataFrame:
    return terms.groupBy(*keys, "termino").agg(F.count("*").cast("int").alias("frecuencia"))


def daily_metrics(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """(fecha, total_noticias, terminos_unicos): all articles count, those with blank titles too."""
    total = rows.groupBy("fecha").agg(F.count("*").cast("int").alias("total_noticias"))
    distinct = terms.select("fecha", "termino").distinct().groupBy("fecha").agg(F.count("*").cast("int").alias("terminos_unicos"))
    return total.join(distinct, "fecha", "left").withColumn("terminos_unicos", F.coalesce("terminos_unicos", F.lit(0)))


def article_ngrams(rows: DataFrame) -> DataFrame:
    """One row per 2-gram and 3-gram of a title: the columns of ``rows``, ``ngrama`` and ``tipo``."""
    plain = with_title(rows).withColumn("_p", once(X.ngram_profile(F.col("titulo"))))
    two = F.transform(X.ngrams(F.col("_p"), 2), lambda g: F.struct(g.alias("g"), F.lit(2).cast("smallint").alias("n")))
    three = F.transform(X.ngrams(F.col("_p"), 3), lambda g: F.struct(g.alias("g"), F.lit(3).cast("smallint").alias("n")))
    return plain.withColumn("_g", once(F.concat(two, three))).withColumn("_g", F.explode("_g")).withColumn("ngrama", F.col("_g.g")).withColumn("tipo", F.col("_g.n")).drop("_g", "_p")


def ngram_counts(grams: DataFrame, *keys: str) -> DataFrame:
    return grams.groupBy(*keys, "ngrama", "tipo").agg(F.count("*").cast("int").alias("n"))


def row_pairs(items: Column) -> Column:
    """All pairs (a, b), a < b, of the items of a row, which are distinct and sorted.  ``items`` should be a plain
    column: what stands in a lambda is made anew for each element."""
    at = F.when(F.size(items) > 1, F.sequence(F.lit(1), F.size(items) - 1)).otherwise(F.array().cast("array<int>"))
    return F.flatten(F.transform(at, lambda i: F.transform(F.slice(items, i + 1, F.size(items)), lambda b: F.struct(F.element_at(items, i).alias("a"), b.alias("b")))))


def pair_counts(rows: DataFrame, *keys: str, longest: int = 150) -> DataFrame:
    """(keys..., termino_a, termino_b, n): articles whose title holds both terms."""
    own = with_title(rows).withColumn("_t", once(X.title_terms(F.col("titulo"), pairs=True)))
    own = own.withColumn("_t", F.array_sort(F.array_distinct(F.filter("_t", lambda x: F.length(x) <= longest))))
    pairs = own.select(*keys, once(row_pairs(F.col("_t"))).alias("_p")).select(*keys, F.explode("_p").alias("_p"))
    return pairs.groupBy(*keys, F.col("_p.a").alias("termino_a"), F.col("_p.b").alias("termino_b")).agg(F.count("*").cast("int").alias("n"))


def frequent_ngrams(ngrams: DataFrame, least: int = 50) -> DataFrame:
    """(ngrama, total) of n-grams of two or three words with at least ``least`` occurrences."""
    return ngrams.where("tipo in (2, 3) and ngrama is not null").groupBy("ngrama").agg(F.sum("n").alias("total")).where(F.col("total") >= least)


def dynamic_compounds(ngrams: DataFrame, least: int = 50) -> DataFrame:
    """(patron, etiqueta, total): patterns of frequent n-grams and the label that takes their place, the words without
    plural; ``total`` are the n-gram's occurrences.

    N-grams of other than two or three words, and those that end a longer curated pattern, are left out.  The label is a
    pattern too.  Of patterns that come up twice the most frequent n-gram's counts, ties by n-gram.
    """
    endings = sorted({" ".join(p[i:]) for p in D.compounds() for i in range(1, len(p))})
    own = frequent_ngrams(ngrams, least).withColumn("_w", F.split("ngrama", " ")).where(F.size("_w").isin(2, 3) & ~F.col("ngrama").isin(endings))
    own = own.withColumn("etiqueta", F.array_join(F.transform("_w", X.singular), " "))
    both = F.array(F.struct(F.col("ngrama").alias("p"), F.lit(0).alias("k")), F.struct(F.col("etiqueta").alias("p"), F.lit(1).alias("k")))
    own = own.withColumn("_p", F.explode(both))
    first = F.min(F.struct((-F.col("total")).alias("t"), "ngrama", F.col("_p.k").alias("k"), "etiqueta"))
    return own.groupBy(F.col("_p.p").alias("patron")).agg(first.alias("_x")).select("patron", "_x.etiqueta", (-F.col("_x.t")).alias("total"))


def unified(terms: DataFrame, ngrams: DataFrame, *keys: str) -> DataFrame:
    """Terms and n-grams in one relation: (keys..., termino, frecuencia, tipo), tipo 1 for terms."""
    a = terms.select(*keys, "termino", "frecuencia", F.lit(1).cast("smallint").alias("tipo"))
    return a.unionAll(ngrams.select(*keys, F.col("ngrama").alias("termino"), F.col("n").alias("frecuencia"), "tipo"))


def monthly(terms: DataFrame, *keys: str) -> DataFrame:
    """Monthly sums; ``fecha`` is the first of the month."""
    return terms.groupBy(F.trunc("fecha", "month").alias("fecha"), *keys, "termino").agg(F.sum("frecuencia").alias("frecuencia"))


def weekly_shares(terms: DataFrame, *keys: str) -> DataFrame:
    """(semana, fecha_inicio, keys..., termino, n, p_semana): a term's share of the week's occurrences.  Inferred."""
    start = F.to_date(F.date_trunc("week", F.col("fecha")))
    by = terms.groupBy(start.alias("fecha_inicio"), *keys, "termino").agg(F.sum("frecuencia").alias("n"))
    total = by.groupBy("fecha_inicio", *keys).agg(F.sum("n").alias("_t"))  # joined, for a window would sort a week in one task
    share = F.round(F.col("n") / F.col("_t"), 6).cast("decimal(10,6)")
    return by.join(total, ["fecha_inicio", *keys]).select(F.weekofyear("fecha_inicio").alias("semana"), "fecha_inicio", *keys, "termino", "n", share.alias("p_semana"))


def tfidf(terms: DataFrame) -> DataFrame:
    """(fecha_semana, fuente, termino, tfidf): tf * ln(N / df) of a week; tf is the share within the source, df the
    number of the week's N sources with the term.  Inferred."""
    week = F.to_date(F.date_trunc("week", F.col("fecha"))).alias("fecha_semana")
    by = terms.groupBy(week, "fuente", "termino").agg(F.sum("frecuencia").alias("n"))
    total = by.groupBy("fecha_semana", "fuente").agg(F.sum("n").alias("_t"))
    sources = total.groupBy("fecha_semana").agg(F.count("*").alias("_s"))
    df = by.groupBy("fecha_semana", "termino").agg(F.count("*").alias("_df"))
    out = by.join(total, ["fecha_semana", "fuente"]).join(sources, "fecha_semana").join(df, ["fecha_semana", "termino"])
    return out.select("fecha_semana", "fuente", "termino", F.round(F.col("n") / F.col("_t") * F.log(F.col("_s") / F.col("_df")), 6).alias("tfidf"))


def top(rows: DataFrame, by: str, *ties: str, n: int) -> DataFrame:
    """The ``n`` rows of highest ``by``; ties in order of ``ties``."""
    return rows.orderBy(F.desc(by), *ties).limit(n)


def top_per_group(rows: DataFrame, group: str, by: str, *ties: str, n: int = 1) -> DataFrame:
    own = Window.partitionBy(group).orderBy(F.desc(by), *ties)
    return rows.withColumn("_r", F.row_number().over(own)).where(F.col("_r") <= n).drop("_r")
