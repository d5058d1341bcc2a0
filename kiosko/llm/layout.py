"""The detector of tables and lists: what the lines of a text, taken together, look like (problem 8).

Each line that isn't blank gets figures of its *block*, the lines up to ``AROUND_LINES`` above and below it:

* vertical alignment of delimiters: the share of lines whose delimiters are those of the line ``lag`` further on, judged
  by their numbers, by their order (fields of words collapsed) and by the column of the first of them;
* periodicity of indentation and list marks: the share of lines that open with the mark or indentation of the line
  ``lag`` further on;
* autocorrelation of line lengths;

each at the best of the lags 1 to ``LAGS``, and beside them the ratios of symbols, digits, closed lines, lines opened in
lower case, common words, word length and line length.  A small additive logistic model of these figures, piecewise
linear in each, marks the lines of tables and lists.  Runs of marked lines are the *spans*; their characters are no prose.
"""

from __future__ import annotations

import numpy as np

#: Lines are compared with those up to so many lines away, among the lines so near (the block), and in the whole text.
LAGS = 8
AROUND_LINES = 12
#: Names of the figures of a block, in order, then of the line itself.
BLOCK = ("marcas", "orden", "columna", "apertura", "autocorrelacion", "simbolos", "cifras", "cerradas", "minusculas", "comunes", "palabra", "palabras", "largo", "variacion", "lineas")
LINE = ("marcas_propias", "orden_propio", "columna_propia", "apertura_propia", "largo_propio", "simbolos_propios", "cifras_propias")
#: Knots of each figure's piecewise linear part: these quantiles of the sample.
KNOTS = (0.1, 0.3, 0.5, 0.7, 0.9)
#: Log odds from which on a line is marked as one of a table or list.
MARKED = 1.5
#: A block of fewer lines has no layout.
LEAST_LINES = 3


def within(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Sums of ``x`` over lo <= i < hi."""
    total = np.concatenate([[0.0], np.cumsum(x, dtype=float)])
    return total[hi] - total[lo]


def repetition(doc: np.ndarray, kinds: list[np.ndarray], size: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """(line, len(kinds) + 1): for each of ``kinds`` (0 stands for none) the share of the lines lo <= i < hi that have what
    the line ``lag`` further on has, and the autocorrelation of ``size``, each at its best lag.

    A lag counts where there are two periods of it.  Autocorrelation is 1 for four lines or more of one length, nan for
    fewer than two lines or two or three of one length.
    """
    n, count = len(doc), hi - lo
    out = np.zeros((n, len(kinds) + 1))
    mean = within(size, lo, hi) / np.maximum(count, 1)
    var = within(size * size, lo, hi) - count * mean * mean
    varied = var > 1e-6 * np.maximum(count * mean * mean, 1)
    out[:, -1] = np.where(count < 2, np.nan, np.where(varied, -1.0, np.where(count >= 4, 1.0, np.nan)))
    for lag in range(1, LAGS + 1):
        if n <= lag:
            break
        same = doc[lag:] == doc[:-lag]
        x, y = size[:-lag] * same, size[lag:] * same
        a = np.minimum(lo, n - lag)
        b = np.clip(hi - lag, a, n - lag)
        pairs = b - a
        fit = count >= 2 * lag
        for j, kind in enumerate(kinds):
            hit = same & (kind[lag:] == kind[:-lag]) & (kind[lag:] != 0)
            out[:, j] = np.maximum(out[:, j], np.where(fit, within(hit, a, b) / np.maximum(pairs, 1), 0))
        cov = within(x * y, a, b) - mean * within(x + y, a, b) + pairs * mean * mean
        out[:, -1] = np.where(fit & varied, np.maximum(out[:, -1], np.clip(cov / np.where(varied, var, 1), -1, 1)), out[:, -1])
    return out


def shared(doc: np.ndarray, kinds: list[np.ndarray]) -> np.ndarray:
    """(line, len(kinds)): 1 for a line that has what a line up to ``LAGS`` away has, else 0."""
    out = np.zeros((len(doc), len(kinds)))
    for lag in range(1, min(LAGS, len(doc) - 1) + 1):
        same = doc[lag:] == doc[:-lag]
        for j, kind in enumerate(kinds):
            hit = same & (kind[lag:] == kind[:-lag]) & (kind[lag:] != 0)
            out[lag:, j] = np.maximum(out[lag:, j], hit)
            out[:-lag, j] = np.maximum(out[:-lag, j], hit)
    return out


class Lines:
    """The lines of a batch of texts that aren't blank, with their figures.

    ``at`` numbers the line of each, ``doc`` its text, ``chars`` its characters without blanks; ``block`` are the figures
    of ``BLOCK`` and ``LINE``, ``text`` (alignment, periodicity, autocorrelation) those of the whole text, and ``said``
    the share of closed lines by line.
    """

    def __init__(self, s):
        line = s.lines()
        k = int(line[-1]) + 1 if len(line) else 0
        inner = s.body & ~s.blank
        words = s.word | s.digit
        self.at = filled = np.flatnonzero(np.bincount(line[inner], minlength=k))
        n = len(filled)
        of = lambda x: np.bincount(line, weights=x, minlength=k)[filled]
        places = np.flatnonzero(inner)
        own = line[places]
        head = places[np.searchsorted(own, filled)]
        last = places[np.searchsorted(own, filled, side="right") - 1] if n else places
        first = np.searchsorted(line, filled)
        self.doc = doc = s.doc[head]
        self.closed = s.closing[last].astype(float)
        indent = np.minimum(head - first, 15)
        marks = np.zeros(n, np.int64)
        for kind in range(1, 11):
            marks += np.minimum(of(s.kind == kind), 7).astype(np.int64) << (3 * kind)
        # the order of delimiters and figures: a polynomial of their classes
        some = np.flatnonzero(s.body & (s.digit | (s.kind > 0) | (inner & ~words)))
        rank = np.arange(len(some)) - np.searchsorted(line[some], line[some])
        code = np.where(s.digit[some], 7, s.cls[some] + 11).astype(np.uint64)
        power = np.concatenate([[1], np.cumprod(np.full(int(rank.max(initial=0)) + 1, 0x9E3779B97F4A7C15, np.uint64))]).astype(np.uint64)
        order = np.zeros(k, np.uint64)
        np.add.at(order, line[some], code * power[rank])
        # the column of the first delimiter
        ends = np.cumsum(s.len)
        begins = ends - s.len
        cut = np.flatnonzero((s.kind > 0) & s.body)
        column = np.zeros(k, np.int64)
        lead, where = np.unique(line[cut], return_index=True)
        column[lead] = 1 + begins[cut[where]] - begins[np.searchsorted(line, lead)] if len(lead) else 0
        mark = np.where(s.word[head], 0, s.cls[head] << 4) + indent
        chars = of(s.len * inner)
        self.chars = chars
        i = np.arange(n)
        start, end = np.searchsorted(doc, doc), np.searchsorted(doc, doc, side="right")
        lo, hi = np.maximum(i - AROUND_LINES, start), np.minimum(i + AROUND_LINES + 1, end)
        ratio = lambda a, b: within(a, lo, hi) / np.maximum(within(b, lo, hi), 1e-9)
        one = np.ones(n)
        symbols, figures = of(s.len * (inner & ~words)), of(s.len * s.digit)
        mean = ratio(chars, one)
        spread = np.sqrt(np.maximum(ratio(chars * chars, one) - mean * mean, 0))
        kinds = [marks, order[filled].astype(np.int64), column[filled], mark]
        self.block = np.column_stack([
            np.nan_to_num(repetition(doc, kinds, chars, lo, hi)),
            ratio(symbols, chars), ratio(figures, chars), ratio(self.closed, one), ratio(s.lower[head].astype(float), one),
            ratio(of(s.common), of(s.word)), ratio(of(s.len * s.word), of(s.word)), np.log1p(ratio(of(s.word), one)), np.log1p(mean), spread / np.maximum(mean, 1), np.log(np.maximum(hi - lo, 1)),
            shared(doc, kinds), np.log1p(chars), symbols / np.maximum(chars, 1), figures / np.maximum(chars, 1),
        ])
        self.text = repetition(doc, [marks, np.where(s.word[head], s.cls[head] << 4, mark) + indent], chars, start, end)
        self.many = (end - start) >= LEAST_LINES

    def by_doc(self, x: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(self.doc, weights=x, minlength=n)[:n]


class Detector:
    """The fitted combination: knots, means, deviations and weights; some hundred numbers."""

    def __init__(self, knots: list[np.ndarray], shift: np.ndarray, scale: np.ndarray, weights: np.ndarray):
        self.knots, self.shift, self.scale, self.weights = knots, shift, scale, weights

    def marked(self, lines: Lines) -> np.ndarray:
        """Which lines belong to a table or list."""
        if not len(lines.doc):
            return np.zeros(0, bool)
        odds = (_basis(lines.block, self.knots) - self.shift) / self.scale @ self.weights[:-1] + self.weights[-1]
        return lines.many & (odds >= MARKED)


def _basis(x: np.ndarray, knots: list[np.ndarray]) -> np.ndarray:
    return np.hstack([x, *(np.maximum(x[:, [j]] - q[None, :], 0) for j, q in enumerate(knots))])


def fit_detector(lines: Lines, prose: np.ndarray, steps: int = 300, rate: float = 0.05, decay: float = 0.3) -> Detector | None:
    """From labels of documents.  Each document of ``LEAST_LINES`` lines or more counts alike, shared among its lines by
    characters, and both kinds count alike; the fewer there are, the closer the weights stay to 0.  None without
    documents of both kinds."""
    use = lines.many
    label = ~prose[lines.doc]
    if not (use & label).any() or not (use & ~label).any():
        return None
    x, d, y, chars = lines.block[use], lines.doc[use], label[use].astype(float), lines.chars[use]
    knots = [np.unique(np.quantile(x[:, j], KNOTS)) for j in range(x.shape[1])]
    b = _basis(x, knots)
    shift, scale = b.mean(0), b.std(0) + 1e-9
    b = (b - shift) / scale
    w = chars / np.maximum(np.bincount(d, weights=chars), 1e-9)[d]
    w = w * np.where(y > 0, 0.5 / (w * y).sum(), 0.5 / (w * (1 - y)).sum())
    decay /= len(np.unique(d))
    a = np.hstack([b, np.ones((len(b), 1))])
    theta = np.zeros(a.shape[1])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(a @ theta, -30, 30)))
        g = a.T @ (w * (p - y)) + decay * theta
        m = 0.9 * m + 0.1 * g
        v = 0.98 * v + 0.02 * g * g
        theta -= rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.98**i)) + 1e-8)
    return Detector(knots, shift, scale, theta)
