"""From pages, links and feeds to articles."""

from __future__ import annotations

import datetime
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiosko.functions import dates, text
from kiosko.sources.tables import first_of

REQUIRED = ("titulo", "fecha", "url", "fuente")


def article_id(url: Column, source: Column) -> Column:
    return F.md5(F.concat(url, F.lit("_"), source))


def prepared(batch: DataFrame, today: datetime.date) -> DataFrame:
    """A raw batch as rows of ``noticias``: missing columns added, dates parsed, rows without url, source or date left
    out, the first of each (url, fuente) kept, id, clean body and year derived.

    ``orden`` says which row is the first, if the batch has it; else the least row.
    """
    missing = [c for c in REQUIRED if c not in batch.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    for c, v in (("bajada", None), ("cuerpo", None), ("fecha_scraping", today.isoformat())):
        if c not in batch.columns:
            batch = batch.withColumn(c, F.lit(v).cast("string"))
    day = lambda c: F.col(c) if dict(batch.dtypes)[c] == "date" else dates.parse_date(F.col(c).cast("string"))
    own = batch.withColumn("fecha", day("fecha")).withColumn("fecha_scraping", day("fecha_scraping"))
    own = own.where("url <> '' and fuente is not null and fecha is not null")
    order = ["orden"] if "orden" in batch.columns else ["fecha", "titulo", "fecha_scraping", "bajada", "cuerpo"]
    own = first_of(own, ["url", "fuente"], *order)
    return own.select(
        article_id(F.col("url"), F.col("fuente")).alias("id"), "titulo", "bajada", "cuerpo", text.clean_body(F.col("cuerpo")).alias("cuerpo_limpio"),
        "fecha", "fecha_scraping", "url", "fuente", F.year("fecha").alias("año"), F.lit(None).cast("timestamp").alias("created_at"),
    ).where("titulo is not null")


def unknown(urls: DataFrame, known: DataFrame) -> DataFrame:
    """URLs that no known article has."""
    return urls.join(known.select("url").where("url is not null"), "url", "left_anti")


def absolute(url: Column, host: str) -> Column:
    """A link as an absolute URL: ``//x``, ``/x`` and ``www.x`` completed."""
    return (
        F.when(url.startswith("//"), F.concat(F.lit("https:"), url))
        .when(url.startswith("/"), F.concat(F.lit(f"https://{host}"), url))
        .when(url.startswith("www."), F.concat(F.lit("https://"), url))
        .otherwise(url)
    )


def wanted_links(urls: DataFrame, shortest: int = 30, keep: str | None = None, drop: str | None = None) -> DataFrame:
    """Distinct links longer than ``shortest`` that match ``keep`` and don't match ``drop``."""
    rows = urls.where(F.length("url") > shortest)
    if keep:
        rows = rows.where(F.col("url").rlike(keep))
    if drop:
        rows = rows.where(~F.col("url").rlike(drop))
    return rows.distinct()


def archived_urls(lines: DataFrame, keep: str, drop: str) -> DataFrame:
    """(url) from lines of a web archive's index: kept by pattern, without query, https, distinct."""
    own = lines.where(F.col("value").rlike(keep)).select(F.regexp_replace(F.regexp_replace("value", r"\?.*$", ""), "^http:", "https:").alias("url"))
    return own.where(~F.col("url").rlike(drop)).distinct()


def page_count(days: Column, per_day: float = 1.5, least: int = 2, most: int | None = None) -> Column:
    """How many pages to read of a source whose last article is ``days`` old."""
    n = F.ceil(days * per_day)
    return F.greatest(F.lit(least), n if most is None else F.least(n, F.lit(most))).cast("int")


def attribute(html: Column, name: str) -> Column:
    """The content of a meta element by its name, property or itemprop, before or after it; null if there is none."""
    named, content = rf"""(?:name|property|itemprop)\s*=\s*["']{re.escape(name)}["']""", r"""content\s*=\s*(?:"([^"]*)"|'([^']*)')"""
    tries = [F.regexp_extract(html, rf"(?is)<meta\s[^>]*{a}[^>]*{b}", i) for a, b in ((named, content), (content, named)) for i in (1, 2)]
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in tries])


def html_title(html: Column) -> Column:
    found = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    return F.when(F.trim(found) != "", F.trim(found))


def paragraphs(html: Column) -> Column:
    """The texts of all paragraphs, without tags, joined by line breaks."""
    parts = F.regexp_extract_all(html, F.lit(r"(?is)<p(?:\s[^>]*)?>(.*?)</p>"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.trim(F.regexp_replace(p, "<[^>]*>", ""))), "\n")


def published(html: Column, url: Column) -> Column:
    """The date of a page: in its URL, else its linked data, else a meta element, else a time element."""
    day = lambda shape: F.try_to_date(F.nullif(F.regexp_extract(html, shape, 1), F.lit("")))
    return F.coalesce(
        dates.url_date(url),
        day(r'"datePublished"\s*:\s*"([0-9]{4}-[0-9]{2}-[0-9]{2})'),
        F.try_to_date(F.substring(F.coalesce(attribute(html, "datePublished"), attribute(html, "article:published_time")), 1, 10)),
        day(r'(?is)<time[^>]*datetime="([0-9]{4}-[0-9]{2}-[0-9]{2})'),
    )


def date_verdict(date: Column, floor: datetime.date | None, today: datetime.date) -> Column:
    """``fuera de rango`` before the floor, ``fecha futura`` from the day after tomorrow on (a wrong reading), ``sin fecha``
    for null, else ``ok``."""
    early = F.lit(False) if floor is None else date < F.lit(floor)
    return F.when(date.isNull(), "sin fecha").when(early, "fuera de rango").when(date > F.lit(today + datetime.timedelta(days=1)), "fecha futura").otherwise("ok")


def backfilled(pages: DataFrame, known: DataFrame, floor: datetime.date | None, today: datetime.date) -> DataFrame:
    """(url, fecha, veredicto) of the pages (url, html) that no known article has: their date by ``published``, judged."""
    new = unknown(pages, known).withColumn("fecha", published(F.col("html"), F.col("url")))
    return new.select("url", "fecha", date_verdict(F.col("fecha"), floor, today).alias("veredicto"))


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.skip = 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style")
        if tag in ("p", "br", "div", "li", "h1", "h2", "h3"):
            self.out.append("\n")

    def handle_endtag(self, tag):
        if tag in ("script", "style") and self.skip:
            self.skip -= 1

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def plain_text(html: str) -> str:
    p = _Text()
    p.feed(html)
    p.close()
    return "\n".join(x for line in "".join(p.out).split("\n") if (x := " ".join(line.split())))


@F.pandas_udf(T.StringType())
def html_text(s: pd.Series) -> pd.Series:
    """HTML as text, entities resolved, scripts and styles left out."""
    return s.map(plain_text, na_action="ignore")


class _Links(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.out: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "a" and (href := dict(attrs).get("href")):
            self.out.append(href)


def links(pages: DataFrame) -> DataFrame:
    """(page, url): the links of (page, html), each once a page."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for page, html in zip(f["page"], f["html"], strict=True):
                p = _Links()
                p.feed(html or "")
                rows += [(page, u) for u in dict.fromkeys(p.out)]
            yield pd.DataFrame(rows, columns=["page", "url"])

    return pages.select(F.col("page").cast("string"), "html").mapInPandas(run, "page string, url string")


def feed_articles(lines: DataFrame, schema: str = "post_title string, post_URL string, raw_post_date string, post_content string") -> DataFrame:
    """(titulo, url, fecha, cuerpo) of a JSON feed, one object a line; unreadable lines give nothing."""
    own = lines.select(F.from_json("value", schema).alias("j")).where("j is not null")
    return own.select(F.col("j.post_title").alias("titulo"), F.col("j.post_URL").alias("url"), F.substring("j.raw_post_date", 1, 10).alias("fecha"), html_text(F.col("j.post_content")).alias("cuerpo")).where("titulo is not null")


def run_health(runs: DataFrame, slow: int = 240, limit: int = 300) -> DataFrame:
    """With ``salud`` of scraper runs (rc, filas, segundos): TIMEOUT, FALLO, VACIO, LENTO or OK."""
    state = (
        F.when((F.col("rc") == 124) | (F.col("segundos") >= limit), "TIMEOUT").when(F.col("rc") != 0, "FALLO").when(F.col("filas") == 0, "VACIO")
        .when(F.col("segundos") >= slow, "LENTO").otherwise("OK")
    )
    return runs.withColumn("salud", state)
