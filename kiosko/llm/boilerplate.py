"""Problem 4: lines repeated across the documents of one source.

Lines are normalised and hashed (128 bits) once, into a table without texts; the distinct documents of each (source, hash)
are counted, first distinct by document, so that a line in every document of a large source is no hot key; the hashes
above the threshold are joined back to the lines' places, from which the documents are rebuilt.

A line that stands in a share of at least s of a source's documents takes a share of s of each of them, so a source has
at most (mean lines of a document) / s such lines, whatever its size.  The found lines of all sources are broadcast if
they are few; else lines meet them by (source, hash), those that are in very many documents apart (``plans.common.joined``).

Defined results: null bodies have no lines; rows of a document (equal ids) are one document; null sources count as a
source of their own; null ids are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiosko.plans.common import hinted, joined, once, written

#: White space other than a line break, in Java's syntax.
_BLANK = r"[\t\x0b\f\r\x1c-\x1f\x85\p{Z}]+"


#: The repeated lines of all sources are broadcast, by two hashes each, if they are at most so many.
BROADCAST_LINES = 500_000


def normal_lines(body: Column) -> Column:
    """The lines of a body, compared in lower case, with white space trimmed and squeezed and digits made one mark."""
    flat = F.regexp_replace(F.regexp_replace(F.lower(body), _BLANK, " "), r"\p{Nd}+", "0")
    return F.split(F.regexp_replace(flat, r" ?\n ?", "\n"), "\n", -1)


def hashed_lines(body: Column) -> Column:
    """Two 64-bit hashes of each normalised line; null where it is blank."""
    lines = F.transform(normal_lines(body), lambda x: F.trim(x))
    return F.transform(lines, lambda x: F.when(x != "", F.struct(F.xxhash64(x).alias("h"), F.xxhash64(F.lit(1), x).alias("g"))))


def _documents(docs: DataFrame, key: str, source: str, body: str) -> DataFrame:
    return docs.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.coalesce(F.col(source), F.lit("\0")).alias("s"), F.col(body).alias("t"))


def hashed(docs: DataFrame, key: str = "id", source: str = "fuente", body: str = "cuerpo") -> DataFrame:
    """(k, s, b, lines): each row's document, source, hash of the body and hashed lines, as a table; the texts are read
    once.  Rows without a body are left out."""
    own = _documents(docs, key, source, body).where("t is not null")
    return written(own.select("k", "s", F.xxhash64("t").alias("b"), hashed_lines(F.col("t")).alias("lines")))


def repeated_lines(own: DataFrame, least: int = 4, share: float = 0.02) -> DataFrame:
    """(s, h, g, n, total), as a table: the lines in at least ``least`` documents and ``share`` of a source's documents with
    non-blank body, by the two hashes of the line, from ``hashed`` documents."""
    total = own.where(F.exists("lines", lambda x: x.isNotNull())).select("s", "k").distinct().groupBy("s").agg(F.count("*").alias("total"))
    lines = own.select("s", F.xxhash64("k").alias("k1"), F.xxhash64(F.lit(1), "k").alias("k2"), F.explode(F.array_distinct("lines")).alias("x"))
    lines = lines.where("x is not null").select("s", F.col("x.h").alias("h"), F.col("x.g").alias("g"), "k1", "k2")
    counts = lines.distinct().groupBy("s", "h", "g").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return written(counts.join(total, "s").where(F.col("n") + 1e-9 >= F.col("total") * share))  # the product may be a little above a whole number


def _places(own: DataFrame, found: DataFrame) -> DataFrame:
    """(s, h, g, k, b, i, n, total): each place of a found line, lines numbered from 0."""
    lines = own.select("k", "s", "b", F.posexplode("lines").alias("i", "x")).where("x is not null").select("k", "b", "i", "s", F.col("x.h").alias("h"), F.col("x.g").alias("g"))
    return joined(lines, found, ["s", "h", "g"], "n", BROADCAST_LINES)


def repeated_places(docs: DataFrame, key: str = "id", source: str = "fuente", body: str = "cuerpo", least: int = 4, share: float = 0.02) -> DataFrame:
    """(id, nro_linea): each place of a repeated line, lines numbered from 1."""
    own = hashed(docs, key, source, body)
    places = _places(own, repeated_lines(own, least, share))
    return places.select(F.col("k").alias(key), (F.col("i") + 1).alias("nro_linea")).distinct()


def without_repeated(docs: DataFrame, key: str = "id", source: str = "fuente", body: str = "cuerpo", least: int = 4, share: float = 0.02) -> DataFrame:
    """(id, cuerpo): each document's body without the repeated lines of its source.  Bodies without any stay as they
    are, null stays null; a body of nothing else becomes empty.  Each row of the input gives a row."""
    own = hashed(docs, key, source, body)
    found = repeated_lines(own, least, share)
    rows = _documents(docs, key, source, body)
    if hinted(found, BROADCAST_LINES) is not found:  # by source, so that no body is moved
        by_source = F.broadcast(found.groupBy("s").agg(F.collect_set(F.struct("h", "g")).alias("own")))
        rows = rows.join(by_source, "s", "left").withColumn("lines", once(F.when(F.col("own").isNotNull(), hashed_lines(F.col("t")))))
        rows = rows.withColumn("hit", once(F.array_compact(F.array_intersect("lines", "own"))))
        gone = lambda i: F.coalesce(F.array_contains("hit", F.get("lines", i)), F.lit(False))
    else:  # by body
        places = _places(own, found).groupBy("k", "s", "b").agg(F.collect_set("i").alias("hit"))
        rows = rows.withColumn("b", F.xxhash64("t")).join(places, ["k", "s", "b"], "left")
        gone = lambda i: F.array_contains("hit", i)
    rest = F.filter(F.split("t", "\n", -1), lambda _, i: ~gone(i))
    kept = F.when(F.size("hit") > 0, F.array_join(rest, "\n")).otherwise(F.col("t"))
    return rows.select(F.col("k").alias(key), kept.alias(body))


def source_report(docs: DataFrame) -> DataFrame:
    """(fuente, articulos, linea, total): the repeated lines by source, each in its normalised spelling, which is taken
    from one of its places."""
    own = hashed(docs)
    one = _places(own, repeated_lines(own)).groupBy("s", "h", "g", "n", "total").agg(F.min(F.struct("k", "b", "i")).alias("p"))
    one = hinted(written(one.select("s", "n", "total", "p.k", "p.b", "p.i")))
    spelled = _documents(docs, "id", "fuente", "cuerpo").where("t is not null").withColumn("b", F.xxhash64("t")).join(one, ["k", "s", "b"])
    line = F.trim(F.element_at(normal_lines(F.col("t")), F.col("i") + 1))
    return spelled.select(F.when(F.col("s") != "\0", F.col("s")).alias("fuente"), line.alias("linea"), F.col("n").alias("articulos"), "total").distinct()
