"""Problem 8: figures on the quality of a text, by which natural prose is told from lists, tables and junk.

1. The detector of ``layout`` marks the spans of tables and lists, from the vertical alignment of delimiters, the
   periodicity of indentation and list marks and the autocorrelation of line lengths over the lags 1 to 8, combined with
   the ratios of symbols, punctuation and words.  What it marks is no prose, whatever its words are.
2. What is left is cut into sentences; a logistic model of their words' classes and order, fitted on what the detector
   left of the labelled documents, tells sentences from strings without meaning and words that form no sentences.

A document is prose if at least half of its characters lie outside of the spans and in sentences.

Defined results: a null or blank text has zero words, null ratios and no ``es_prosa``; rows with equal ids are judged
one by one.  Without labels of both kinds fixed rules on layout, common words and symbols take the models' places.  The
layout figures of a text of more than ``prose.BATCH`` characters are the mean of its parts by lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiosko.llm import layout as L
from kiosko.llm import prose as P
from kiosko.llm.consistent import consistent

#: The bounded sample of labelled documents that the model is fitted on: so many documents, none longer than that.
SAMPLE_DOCS = 4000
SAMPLE_CHARS = 20_000

#: Share of words that are the word a period further on, from which a segment is no sentence.
REPEATED = 0.6

FIGURES = (
    "palabras bigint, largo_medio double, simbolos double, lineas_puntuadas double, comunes double, "
    "alineadas double, periodicidad double, autocorrelacion double, marcada double, prosa double"
)


class Model:
    """What is broadcast: the detector's some hundred numbers, at most ``prose.BUCKETS`` weights, the known words and the
    common words.  A part that is None is replaced by its fixed rule."""

    def __init__(self, detector: L.Detector | None, weights: np.ndarray | None, known: frozenset[str], common: frozenset[str]):
        self.detector, self.weights, self.known, self.common = detector, weights, known, common


def spans(s: P.Segments, lines: L.Lines, model: Model) -> np.ndarray:
    """Which segments lie in a table or list."""
    if model.detector is not None:
        marked = model.detector.marked(lines)
    else:
        figure = {name: lines.block[:, j] for j, name in enumerate(L.BLOCK + L.LINE)}
        one = lambda block, own: (figure[block] >= 0.6) & (figure[own] > 0)
        aligned = one("marcas", "marcas_propias") | one("orden", "orden_propio") | one("columna", "columna_propia")
        listed = one("apertura", "apertura_propia") & (figure["autocorrelacion"] >= 0.3)
        marked = lines.many & (figure["cerradas"] < 0.5) & (aligned | listed)
    by_line = np.zeros(int(s.lines()[-1]) + 1 if len(s.cls) else 0, bool)
    by_line[lines.at] = marked
    return by_line[s.lines()[s.starts]]


def sentences(s: P.Segments, model: Model) -> np.ndarray:
    """Which segments are sentences.  One that says the same words again and again is none, whatever they are."""
    return _worded(s, model) & (s.repeated() < REPEATED)


def _worded(s: P.Segments, model: Model) -> np.ndarray:
    if model.weights is not None:
        return P.segment_scores(s, model.weights) > 0
    said, shared = s.sums(s.word.astype(float)), s.sums(s.common.astype(float))
    chars, symbols = s.sums(s.len * (s.body & ~s.blank)), s.sums(s.len * (s.body & ~s.blank & ~s.word & ~s.digit))
    return (said >= 5) & (shared >= 0.15 * said) & (shared <= 0.75 * said) & (symbols < 0.25 * chars)


def fit_model(documents: DataFrame, labels: DataFrame, common: frozenset[str], docs: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> Model:
    """A model from ``labels`` (doc_id, prosa).  Several labels of a document are averaged, ties and nulls left out.

    The sample is the ``docs`` labelled documents of lowest hash among those of at most ``chars`` characters.
    """
    voted = (
        labels.where("doc_id is not null and prosa is not null")
        .groupBy("doc_id")
        .agg(F.avg(F.col("prosa").cast("double")).alias("voto"))
        .where("voto <> 0.5")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(docs)
    )
    sample = (
        documents.select("doc_id", "text")
        .where((F.length("text") <= chars) & (F.trim("text") != ""))
        .join(F.broadcast(voted), "doc_id")  # at most `docs` rows
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(docs)
        .collect()
    )
    texts = [consistent(r.text, layout=True) for r in sample]
    y = np.array([r.voto > 0.5 for r in sample], bool)
    if not len(y) or y.all() or not y.any():
        return Model(None, None, frozenset(), common)
    return fitted(texts, y, common)


def fitted(texts: list[str], prose: np.ndarray, common: frozenset[str]) -> Model:
    """Both models from texts and their labels: the detector first, the sentences from what it leaves."""
    known = P.known_words(texts)
    s = P.Segments(texts, P.Lexicon(known, common))
    lines = L.Lines(s)
    model = Model(L.fit_detector(lines, prose), None, known, common)
    model.weights = P.fit(s, prose, spans(s, lines, model))
    return model


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(b > 0, a / b, np.nan)


def figures(texts: list[str], model: Model, lexicon: P.Lexicon) -> pd.DataFrame:
    """The figures of a list of texts, none of them None."""
    n = len(texts)
    total = np.zeros((15, n))
    for part, own in P.batches([consistent(x, layout=True) for x in texts]):
        s = P.Segments(part, lexicon)
        k = len(part)
        by = lambda x, d=s.doc, k=k: np.bincount(d, weights=x, minlength=k)[:k]
        words = s.word | s.digit
        symbol = s.body & ~words & ~s.blank
        chars = (s.len + 1) * (s.body & ~s.blank)
        lines = L.Lines(s)
        listed = spans(s, lines, model)
        of_line = s.sums(chars).astype(float)
        fine = s.sums(chars * ~s.unword).astype(float) * (sentences(s, model) & ~listed)
        text = lines.text
        rows = (
            by(words), by(s.len * words), by(s.len * symbol), by(s.len * (s.body & ~s.blank)),
            lines.by_doc(np.ones(len(lines.doc)), k), lines.by_doc(lines.closed, k),
            by(s.common), by(s.word),
            s.by_doc(fine, k), by(chars),
            lines.by_doc(text[:, 0], k), lines.by_doc(text[:, 1], k),
            lines.by_doc(np.nan_to_num(text[:, 2]), k), lines.by_doc(~np.isnan(text[:, 2]), k),
            s.by_doc(of_line * listed, k),
        )
        for i, v in enumerate(rows):
            np.add.at(total[i], own, v)
    t = total
    return pd.DataFrame(
        {
            "palabras": t[0].astype(np.int64),
            "largo_medio": _ratio(t[1], t[0]),
            "simbolos": _ratio(t[2], t[3]),
            "lineas_puntuadas": _ratio(t[5], t[4]),
            "comunes": _ratio(t[6], t[7]),
            "alineadas": _ratio(t[10], t[4]),
            "periodicidad": _ratio(t[11], t[4]),
            "autocorrelacion": _ratio(t[12], t[13]),
            "marcada": _ratio(t[14], t[9]),
            "prosa": _ratio(t[8], t[9]),
        }
    )


def quality(documents: DataFrame, labels: DataFrame, common_words: DataFrame, docs: int = SAMPLE_DOCS) -> DataFrame:
    """(doc_id, the figures, es_prosa) for every row of ``documents`` (doc_id, text).  ``common_words`` is a stated list (of
    some hundred words a language) and is broadcast whole."""
    common = frozenset(r[0].lower() for r in common_words.select("palabra").where("palabra is not null").distinct().collect())
    shared = documents.sparkSession.sparkContext.broadcast(fit_model(documents, labels, common, docs))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        lexicon = P.Lexicon(model.known, model.common)
        for b in batches:
            out = figures([x or "" for x in b.column(1).to_pylist()], model, lexicon)
            prose = out["prosa"].to_numpy()
            arrays = [b.column(0), *(pa.array(out[c].to_numpy(), from_pandas=True) for c in out.columns)]
            arrays.append(pa.array(prose >= 0.5, mask=np.isnan(prose)))
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *out.columns, "es_prosa"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(judge, f"doc_id {kind}, {FIGURES}, es_prosa boolean")


def not_prose(documents: DataFrame, labels: DataFrame, common_words: DataFrame) -> DataFrame:
    """(doc_id): documents with non-blank text of which less than half is natural prose."""
    return quality(documents, labels, common_words).where("not es_prosa").select("doc_id").distinct()
