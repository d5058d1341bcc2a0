"""Column expressions of the headline pipeline: normalisation, tokens, n-grams, fusion of names."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiosko.functions import dictionaries as D
from kiosko.plans.common import joined, written

#: Characters that composition can't change: the values made of them stay in the JVM.
_COMPOSED = "^[\\x00-\\x{02ff}\\x{2000}-\\x{206f}]*$"
DASHES = "[\\x{2010}-\\x{2015}]"


@F.pandas_udf(T.StringType())
def _nfc_udf(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


def nfc(col: Column) -> Column:
    """Composed accents.  All rows pass the Python stage, but only values with characters beyond Latin with their text."""
    plain = col.rlike(_COMPOSED)
    return F.when(plain, col).otherwise(_nfc_udf(F.when(~plain, col)))


def _replaced(col: Column, *pairs: tuple[str, str]) -> Column:
    for pattern, by in pairs:
        col = F.regexp_replace(col, pattern, by)
    return col


def ngram_profile(title: Column) -> Column:
    """Lower case, composed; dashes, entities, punctuation, symbols and digits become blanks, squeezed."""
    low = nfc(F.lower(title))
    return F.trim(_replaced(low, (DASHES, " "), ("&[a-z0-9]+;", " "), ("&#[0-9]+;", " "), ("[\\p{P}\\p{S}]", " "), ("\\p{Nd}", " "), ("[\\s\\p{Z}]+", " ")))


def term_profile(title: Column) -> Column:
    """Lower case, composed; dashes become hyphens, entities and quotes blanks; digits and punctuation stay."""
    return _replaced(nfc(F.lower(title)), (DASHES, "-"), ("&[a-z0-9]+;", " "), ("&#[0-9]+;", " "), ("[\"']", " "))


def tokens(text: Column) -> Column:
    """Runs of letters, marks, digits and low lines."""
    return F.regexp_extract_all(text, F.lit("([\\p{L}\\p{M}\\p{N}_]+)"), F.lit(1))


def kept_tokens(toks: Column, least: int = 3) -> Column:
    """Tokens of at least ``least`` characters, with a letter, no stop word."""
    stop = sorted(D.STOPWORDS)  # a set, when it is planned
    return F.filter(toks, lambda x: (F.length(x) >= least) & ~x.isin(stop) & x.rlike("[a-zA-ZñáéíóúüÑÁÉÍÓÚÜ]"))


def ngrams(text: Column, n: int, least: int = 3, longest: int = 300) -> Column:
    """The n-grams of a text of words: none with a stop word or a word shorter than ``least``."""
    words = F.filter(F.split(text, " "), lambda w: w != "")
    stop = sorted(D.STOPWORDS)
    good = F.transform(words, lambda w: F.when((F.length(w) >= least) & ~w.isin(stop), w))
    grams = good
    for k in range(1, n):  # zipped, for a slice in a lambda would make the words anew for each place
        shifted = F.slice(good, F.lit(k + 1), F.greatest(F.size(good) - k, F.lit(0)))
        grams = F.zip_with(grams, shifted, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.filter(grams, lambda g: g.isNotNull() & (F.length(g) <= longest))


def fusion_regex(patterns: dict[tuple[str, ...], str]) -> str:
    """One regular expression over ``<word><word>...`` whose leftmost match is greedy fusion: patterns of three words
    before those of two, any word last.  Valid in Java's and RE2's syntax."""
    heads: dict[tuple[int, str], list[str]] = {}
    for p in patterns:
        rest = "".join(f"<{re.escape(w)}>" for w in p[1:])
        heads.setdefault((len(p), p[0]), []).append(rest)
    parts = [f"<{re.escape(first)}>(?:{'|'.join(rest)})" for (n, first), rest in sorted(heads.items(), key=lambda x: -x[0][0])]
    return "|".join([*parts, "<[^<>]*>"])


def fused_by_regex(toks: Column, patterns: dict[tuple[str, ...], str]) -> Column:
    """Greedy fusion in the JVM; for dictionaries of some hundred patterns."""
    marked = F.array_join(F.transform(toks, lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "")
    found = F.regexp_extract_all(marked, F.lit(f"({fusion_regex(patterns)})"), F.lit(1))
    names = _literal_map({"".join(f"<{w}>" for w in p): name for p, name in patterns.items()})
    one = lambda x: F.substring(x, F.lit(2), F.length(x) - 2)
    return F.transform(found, lambda x: F.when(x.contains("><"), F.try_element_at(names, x)).otherwise(one(x)))  # only fused words are looked up


def fused_by_dictionary(df: DataFrame, column: str, patterns: dict[tuple[str, ...], str]) -> DataFrame:
    """Greedy fusion of an array column by a broadcast dictionary; for dictionaries of any size that fits a process."""
    shared = df.sparkSession.sparkContext.broadcast(D.first_words(patterns))

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = shared.value
        for s in batches:
            yield s.map(lambda x: D.fuse(list(x), index), na_action="ignore")

    return df.withColumn(column, run(F.col(column)))


def fused_by_table(df: DataFrame, column: str, patterns: DataFrame) -> DataFrame:
    """Greedy fusion of an array column by a table (patron, etiqueta, total) of any size, written and of one row a
    pattern: the sequences of two and three words of each row meet it by a join, frequent patterns taken apart, and each
    row is fused with the patterns that it met."""
    own = written(df.withColumn("_r", F.monotonically_increasing_id()))
    words = F.col(column)

    def runs(n: int) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))
        return F.when(F.size(words) >= n, each).otherwise(F.array().cast("array<string>"))

    seen = own.select("_r", F.explode(F.array_distinct(F.concat(runs(2), runs(3)))).alias("patron"))
    met = joined(seen, patterns, ["patron"], "total").groupBy("_r").agg(F.collect_list("patron").alias("_p"), F.collect_list("etiqueta").alias("_e"))

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(tokens: pd.Series, found: pd.Series, labels: pd.Series) -> pd.Series:
        out = []
        for t, p, e in zip(tokens, found, labels, strict=True):
            out.append(None if t is None else list(t) if p is None else D.fuse(list(t), D.first_words({tuple(x.split(" ")): y for x, y in zip(p, e, strict=True)})))
        return pd.Series(out)

    return own.join(met, "_r", "left").withColumn(column, run(column, "_p", "_e")).drop("_r", "_p", "_e")


def _literal_map(d: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def renamed(toks: Column, table: dict[str, str]) -> Column:
    names = _literal_map(table)
    return F.transform(toks, lambda x: F.when(x.isin(list(table)), F.try_element_at(names, x)).otherwise(x))  # a map is searched from end to end


def known_hyphens(toks: Column, names: list[str], least: int = 3) -> Column:
    """Without hyphenated tokens, but for names and for two parts of letters only, each long enough."""
    part = f"[a-zñáéíóúü]{{{least},}}"
    return F.filter(toks, lambda x: ~x.contains("-") | x.isin(names) | x.rlike(f"^{part}-{part}$"))


def title_terms(title: Column, pairs: bool = False) -> Column:
    """The terms of a title with the curated dictionary.  The pairs profile has no lemmas and maps single words before
    it filters hyphens."""
    names = D.compounds(pairs)
    toks = fused_by_regex(kept_tokens(tokens(term_profile(title))), names)
    return canonical_terms(toks, pairs)


def canonical_terms(toks: Column, pairs: bool = False) -> Column:
    canon = sorted(set(D.compounds(pairs).values()))
    toks = renamed(toks, D.hyphens())
    if pairs:
        return known_hyphens(renamed(toks, D.singles()), canon)
    return renamed(renamed(known_hyphens(toks, canon), D.singles()), D.lemmas())


def singular(word: Column) -> Column:
    """A word without its Spanish plural."""
    n = F.length(word)
    cut = lambda k: F.substring(word, F.lit(1), n - k)
    return (
        F.when(word.endswith("ces") & (n > 4), F.concat(cut(3), F.lit("z")))
        .when(word.endswith("es") & (n > 4), cut(2))
        .when(word.endswith("s") & (n > 3), cut(1))
        .otherwise(word)
    )


def whole_word(word: str) -> str:
    """A regular expression for a word in any case, bounded by what is neither letter nor digit."""
    return f"(?iu)(^|[^\\p{{L}}\\p{{N}}_]){re.escape(word)}($|[^\\p{{L}}\\p{{N}}_])"


def clean_body(body: Column, junk: list[str] | frozenset[str] = D.JUNK) -> Column:
    """Body without code, hashtags, punctuation, digits and junk words, in lower case, squeezed; null if blank."""
    text = _replaced(
        F.regexp_replace(body, "\\{\\{.*\\}\\}", ""), ("\\{.*\\}", " "), ("#[^\\n]*[\\p{L}\\p{N}_]", " "), ("var divElement.*\\);", " "),
        ("[\\p{P}\\p{S}]", " "), ("\\p{Nd}", " "),
    )
    text = F.trim(F.regexp_replace(F.lower(text), "[\\s\\p{Z}]+", " "))
    if junk:
        text = F.array_join(F.filter(F.split(text, " "), lambda w: ~w.isin(sorted(junk))), " ")
    return F.when(F.trim(body) != "", text)


def light_clean(text: Column) -> Column:
    """Without feed marks and line breaks, squeezed."""
    return F.trim(_replaced(text, ("dfp:|\\n|\\r", " "), ("[\\s\\p{Z}]+", " ")))
