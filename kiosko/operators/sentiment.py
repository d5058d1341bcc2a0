"""Tone of titles: answers of a classifier, their storage and their aggregates."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiosko.functions.dictionaries import TONES

_LABEL = "|".join(TONES)


def parse_answer(text: str | None, n: int) -> list[str] | None:
    """The labels of a numbered answer: a JSON object, else "1": "label" pairs, else lines like 1. label.

    A missing or unknown label is ``neutral``; None if nothing can be read.
    """
    found: dict[str, str] = {}
    try:
        read = json.loads(text or "")
        if isinstance(read, dict):
            found = {str(k): str(v) for k, v in read.items()}
        elif isinstance(read, list):
            found = {str(i): str(v) for i, v in enumerate(read, 1)}
    except ValueError:
        pass
    if not found:
        found = dict(re.findall(rf'"(\d+)"\s*:\s*"({_LABEL})"', text or ""))
    if not found:
        found = dict(re.findall(rf"(?i)(\d+)[.:]\s*({_LABEL})", text or ""))
    if not found:
        return None
    return [v if (v := found.get(str(i), "neutral").lower()) in TONES else "neutral" for i in range(1, n + 1)]


def parsed(answers: DataFrame) -> DataFrame:
    """(lote, numero, sentimiento) of (lote, respuesta, n): a row for each of the n labels; an answer that can't be read
    gives one row with nulls."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for batch, text, n in zip(f["lote"], f["respuesta"], f["n"], strict=True):
                labels = parse_answer(text, int(n))
                out += [(batch, None, None)] if labels is None else [(batch, i, x) for i, x in enumerate(labels, 1)]
            yield pd.DataFrame(out, columns=["lote", "numero", "sentimiento"]).astype({"numero": "Int32"})

    return answers.select(F.col("lote").cast("string"), "respuesta", "n").mapInPandas(run, "lote string, numero int, sentimiento string")


def prompt(titles: list[str]) -> str:
    lines = "\n".join(f"{i}. {t}" for i, t in enumerate(titles, 1))
    return f"Clasifica el tono de cada titular como {', '.join(TONES)}. Responde un objeto JSON de número a tono.\n{lines}"


def confidence(raw: Column) -> Column:
    """0 to 100: values above 1 are percent already; rounded half to even.  Null stays null."""
    return F.when(raw.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(100), F.bround(F.when(raw > 1, raw).otherwise(raw * 100)).cast("int"))))


def lexicon_answer(text: str) -> str:
    """A classifier that needs no network: it answers ``prompt`` by counting some words."""
    bad = re.compile(r"(?i)\b(muert\w*|robo\w*|incendi\w*|estafa\w*|condena\w*|crisis|azota\w*|homicidi\w*|rechaz\w*)")
    good = re.compile(r"(?i)\b(inaugur\w*|premi\w*|celebr\w*|rescat\w*|estren\w*|mejor\w*|aprueb\w*)")
    out = {}
    for number, title in re.findall(r"(?m)^(\d+)\. (.*)$", text):
        d = len(good.findall(title)) - len(bad.findall(title))
        out[number] = "positivo" if d > 0 else "negativo" if d < 0 else "neutral"
    return json.dumps(out)


def classify(rows: DataFrame, ask: Callable[[str], str] = lexicon_answer, model: str = "lexicon", per_call: int = 30, tries: int = 3) -> DataFrame:
    """(id, sentimiento, modelo) of (id, titulo); ``sentimiento`` is null where no try gave a readable answer."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for first in range(0, len(f), per_call):
                part = f.iloc[first : first + per_call]
                titles = [" ".join(str(t).split()) for t in part["titulo"]]
                labels = None
                for _ in range(tries):
                    try:
                        labels = parse_answer(ask(prompt(titles)), len(part))
                    except Exception:  # noqa: BLE001 - a classifier may fail in any way
                        labels = None
                    if labels is not None:
                        break
                yield pd.DataFrame({"id": part["id"].to_numpy(), "sentimiento": labels or [None] * len(part), "modelo": model})

    return rows.where(F.length("titulo") > 5).select("id", "titulo").mapInPandas(run, "id string, sentimiento string, modelo string")


def pending(rows: DataFrame, done: DataFrame, least: int = 6) -> DataFrame:
    """Rows with a title of some length that have no result yet."""
    return rows.where(F.length("titulo") >= least).join(done.select("id").where("id is not null"), "id", "left_anti")


def retries(rows: DataFrame, errors: DataFrame, least: int = 6) -> DataFrame:
    """(id, titulo, intentos, ultima_vez): articles that failed before, to be ordered by ``ultima_vez``, ``id``."""
    own = rows.where(F.length("titulo") >= least).select("id", "titulo")
    return own.join(errors.where("id is not null").select("id", "intentos", "ultima_vez"), "id")


def failures(old: DataFrame, ids: DataFrame, now: Column, done: DataFrame | None = None) -> DataFrame:
    """(id, intentos, ultima_vez): the error table with one more try for each of ``ids`` and without those ``done``."""
    if done is not None:
        done = done.select("id").where("id is not null").distinct()
        old, ids = old.join(done, "id", "left_anti"), ids.join(done, "id", "left_anti")
    new = ids.select("id").distinct().select("id", F.lit(1).alias("mas"))
    joined = old.join(new, "id", "full")
    return joined.select("id", (F.coalesce("intentos", F.lit(0)) + F.coalesce("mas", F.lit(0))).cast("int").alias("intentos"), F.when(F.col("mas").isNotNull(), now).otherwise(F.col("ultima_vez")).alias("ultima_vez"))


def run_pending(rows: DataFrame, results, ask: Callable[[str], str] = lexicon_answer, model: str = "lexicon", chunk: int = 500, limit: int = 0) -> tuple[int, int, int]:
    """(tried, written, failed) of a run over the pending articles, newest first, ``chunk`` at a time, at most ``limit`` if
    it is above 0.  ``results`` is the table of results: each chunk is upserted before the next one begins, so a run that
    was cut off goes on where it ended.  Answers that can't be read are left pending, and are not tried twice in a run.
    """
    from kiosko.plans.common import written

    tried = good = 0
    failed = None
    while not limit or tried < limit:
        own = pending(rows, results.read())
        if failed is not None:
            own = own.join(failed, "id", "left_anti")
        size = min(chunk, limit - tried) if limit else chunk
        batch = written(own.orderBy(F.desc_nulls_last("fecha"), "id").limit(size).select("id", "titulo"))
        n = batch.count()
        if not n:
            break
        answers = written(classify(batch, ask, model))
        new = answers.where("sentimiento is not null").selectExpr("id", "sentimiento", "modelo", "current_timestamp() as procesado_en", "cast(null as int) as confianza", "cast(null as string) as prompt_version")
        results.upsert(new, "id")
        bad = answers.where("sentimiento is null").select("id")
        failed = bad if failed is None else failed.unionByName(bad)
        tried, good = tried + n, good + n - bad.count()
        if n < size:
            break
    return tried, good, tried - good


def current(results: DataFrame) -> DataFrame:
    """One result per article, the latest by ``procesado_en``; labels in lower case and trimmed, invalid ones left out.
    Ties are broken by the other columns."""
    label = F.lower(F.trim("sentimiento"))
    own = results.withColumn("sentimiento", label).where(label.isin(*TONES) & F.col("id").isNotNull())
    rest = [c for c in ("modelo", "confianza", "prompt_version") if c in results.columns]
    packed = F.struct("procesado_en", "sentimiento", *rest)
    return own.groupBy("id").agg(F.max(packed).alias("_x")).select("id", "_x.*")


def with_tone(rows: DataFrame, results: DataFrame) -> DataFrame:
    return rows.join(current(results), "id")


def tone_counts(toned: DataFrame, *keys) -> DataFrame:
    return toned.groupBy(*keys, "sentimiento").agg(F.count("*").alias("n"))


def _count(label: str) -> Column:
    return F.count(F.when(F.col("sentimiento") == label, 1))


def tone_wide(toned: DataFrame, *keys) -> DataFrame:
    """(keys..., positivo, neutral, negativo, total, neto): net tone in percent, one decimal."""
    wide = toned.groupBy(*keys).agg(*(_count(x).alias(x) for x in TONES), F.count("*").alias("total"))
    return wide.withColumn("neto", F.round((F.col("positivo") - F.col("negativo")) * 100 / F.col("total"), 1))


def by_source(toned: DataFrame, least: int = 10) -> DataFrame:
    """Net tone of the sources with at least ``least`` titles; of all, if none has as many."""
    wide = tone_wide(toned, "fuente")
    enough = F.col("total") >= least
    some = wide.agg(F.max(enough).alias("_some"))
    return wide.join(F.broadcast(some)).where(enough | ~F.col("_some")).drop("_some")  # one row


def net_and_before(toned: DataFrame, start, end) -> DataFrame:
    """One row: counts and net tone of a period and of the period of equal length before it, with the change of the
    rounded figures and the class at +-8."""
    days = (end - start).days + 1
    now = F.col("fecha").between(F.lit(start), F.lit(end))
    then = F.col("fecha").between(F.date_sub(F.lit(start), days), F.date_sub(F.lit(start), 1))
    n = lambda cond, label=None: F.count(F.when(cond & (F.col("sentimiento") == label) if label else cond, 1))
    net = lambda cond: (n(cond, "positivo") - n(cond, "negativo")) * 100 / n(cond)
    some = lambda cond: F.when(n(cond) > 0, F.bround(F.when(n(cond) > 0, net(cond)))).cast("int")
    out = toned.agg(
        *(n(now, x).alias(x) for x in TONES), n(now).alias("total"), F.coalesce(some(now), F.lit(0)).alias("neto"), some(then).alias("neto_previo")
    )
    kind = F.when(F.col("neto") <= -8, "neg").when(F.col("neto") >= 8, "pos").otherwise("neu")
    return out.withColumn("delta", F.col("neto") - F.col("neto_previo")).withColumn("clase", kind)


def covered_months(toned: DataFrame, least: int = 200) -> DataFrame:
    """(desde, hasta, meses): the newest unbroken run of months with at least ``least`` results each."""
    by = toned.groupBy(F.trunc("fecha", "month").alias("mes")).agg(F.count("*").alias("n"), F.min("fecha").alias("lo"), F.max("fecha").alias("hi")).where(F.col("n") >= least)
    newest = Window.orderBy(F.desc("mes"))  # one row a month
    run = by.withColumn("isla", F.add_months("mes", F.row_number().over(newest)))
    run = run.withColumn("primera", F.max("isla").over(Window.partitionBy(F.lit(1))))
    return run.where("isla = primera").groupBy().agg(F.min("lo").alias("desde"), F.max("hi").alias("hasta"), F.count("*").alias("meses")).where("meses > 0")


def coverage(rows: DataFrame, results: DataFrame) -> DataFrame:
    """(clasificadas, total, confianza, modelo): one row."""
    own = rows.select("id").join(current(results).withColumnRenamed("id", "rid"), F.col("id") == F.col("rid"), "left")
    return own.agg(F.count("rid").alias("clasificadas"), F.count("*").alias("total"), F.round(F.avg("confianza")).cast("int").alias("confianza"), F.max("modelo").alias("modelo"))


def actors(toned: DataFrame) -> DataFrame:
    """(actor, positivo, neutral, negativo, total, pct_pos, pct_neg, neto) of (actor, sentimiento): shares in percent."""
    wide = tone_wide(toned, "actor").drop("neto")
    share = lambda x: F.round(100 * F.col(x) / F.col("total"), 1)
    return wide.withColumn("pct_pos", share("positivo")).withColumn("pct_neg", share("negativo")).withColumn("neto", F.round(F.col("pct_pos") - F.col("pct_neg"), 1))
