"""Tokens and segments of whole texts, computed for a batch of documents at once (problem 8).

Everything here works on numpy arrays over all tokens of a batch: one regular expression finds the tokens, a dictionary
turns each into a small class number, and the rest are vector operations, so the cost per character stays low and no
text is cut.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np

TOKEN = re.compile(r"[\n\0]|[^\W\d_]+|\d+(?:[.,:/-]\d+)*|[^\w\s]|_+|\t|\s+")
VOWELS = set("aeiouyáéíóúüàèìòùâêôãõäëïö")
#: Buckets of the segment model: the bound of every table that is collected or broadcast.
BUCKETS = 1 << 16
END, DOC = 1, 2
LONGEST_WORD = 40
#: Words are compared with those up to so many words further on, in segments of so many words or more.
LAGS, LEAST_REPEATED = 8, 8
#: Texts are worked on in batches of about so many characters; a longer text in parts of whole lines.
BATCH = 1 << 20
#: Chunks that a lexicon keeps; beyond, it starts anew with the next batch.
CACHED = 1 << 19
_SENTENCE_END = frozenset(".!?…;")
_CLOSING = frozenset(".!?…:;»”\"'")
DELIMITERS = {"|": 1, ";": 2, ",": 3, "/": 4, ">": 5, "·": 6, ":": 7, "=": 8, "\t": 9, " ": 10}
_CONSONANTS = re.compile("[" + "".join(sorted(VOWELS)) + "]")


def _crc(x: str) -> int:
    return zlib.crc32(x.encode("utf-8", "surrogatepass")) | 8


class Lexicon(dict):
    """Chunk of text without blanks -> number.  A chunk's tokens are found once, however often it is met.

    ``known`` words are classes of their own, all others fall into classes of shape; ``common`` words are counted.
    """

    def __init__(self, known: frozenset[str] = frozenset(), common: frozenset[str] = frozenset()):
        super().__init__()
        self.known, self.common = known, common
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.token: dict[str, int] = {}
        self.flat = array("q")
        self.start = array("q", [0])
        self.columns = [array("q") for _ in range(10)]

    def __missing__(self, chunk: str) -> int:
        for t in TOKEN.findall(chunk) if chunk else (" ",):  # an empty chunk stands between two blanks
            i = self.token.get(t)
            if i is None:
                i = self.token[t] = len(self.token)
                for column, x in zip(self.columns, self.attributes(t), strict=True):
                    column.append(x)
            self.flat.append(i)
        self[chunk] = n = len(self.start) - 1
        self.start.append(len(self.flat))
        return n

    def attributes(self, t: str) -> tuple:
        c = t[0]
        return (
            self.classify(t), len(t), c.isalpha(), c.isdigit(), c.isspace() and c not in "\n", c in _SENTENCE_END, c in _CLOSING,
            t.lower() in self.common, c.islower(), DELIMITERS.get(c, 0),
        )

    def classify(self, token: str) -> int:
        if token == "\n":
            return END
        if token == "\0":
            return DOC
        first = token[0]
        if first.isalpha():
            low = token.lower()
            if low in self.known:
                return _crc("w " + low)
            n = len(low)
            vowels = sum(c in VOWELS for c in low)
            shape = "A" if token.isupper() and n > 1 else "a" if first == low[0] else "Aa" if token[1:] == low[1:] else "aA"
            run = max(map(len, _CONSONANTS.split(low)))
            return _crc(f"s {shape} {min(n, 12) if n < 24 else 24} {round(4 * vowels / n)} {min(run, 5)}")
        if first.isdigit():
            return _crc("n " + re.sub(r"\d+", lambda m: "d" * min(len(m[0]), 4), token)[:12])
        if first.isspace():
            return _crc("g")
        return _crc("p " + first)

    def encode(self, texts: list[str]) -> np.ndarray:
        """Token numbers of all texts; each text is closed by a line break and ``\\0``."""
        if len(self) > CACHED:
            self.reset()
        whole = "".join(x.replace("\0", " ") + "\n\0 " for x in texts).replace("\n", " \n ").replace("  \n", " \n")
        chunks = whole.split(" ")
        chunks.pop()
        ids = np.fromiter(map(self.__getitem__, chunks), np.int64, len(chunks))
        start = np.array(self.start)
        n = np.diff(start)[ids]
        at = np.repeat(start[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return np.array(self.flat)[at]


class Segments:
    """The segments (lines, and sentences within lines) of a batch of texts."""

    def __init__(self, texts: list[str], lexicon: Lexicon):
        t = lexicon.encode(texts)
        n = len(t)
        columns = [np.array(x) for x in lexicon.columns]
        self.cls, self.len = columns[0][t], columns[1][t]
        self.word, self.digit, self.blank, self.stop, self.closing, self.common, self.lower = (x.astype(bool)[t] for x in columns[2:9])
        self.kind = columns[9][t]
        doc_end = self.cls == DOC
        self.doc = np.cumsum(doc_end) - doc_end
        cut = (self.cls == END) | doc_end
        self.body = ~cut
        cut = cut.copy()
        cut[1:] |= self.stop[1:] & self.word[:-1]  # a stop that closes a word ends a sentence, "1." doesn't
        start = np.empty(n, bool)
        if n:
            start[0] = True
            start[1:] = cut[:-1]
        self.seg = np.cumsum(start) - 1
        self.starts = np.flatnonzero(start)
        self.doc_of_seg = self.doc[self.starts]
        #: Letters in a row beyond the length of any word count as characters of no prose.
        self.unword = self.word & (self.len > LONGEST_WORD)

    def sums(self, x: np.ndarray) -> np.ndarray:
        """By segment."""
        return np.add.reduceat(x, self.starts) if len(self.starts) else np.zeros(0, x.dtype)

    def by_doc(self, x: np.ndarray, n: int) -> np.ndarray:
        """Sums of a figure of segments by document."""
        return np.bincount(self.doc_of_seg, weights=x, minlength=n)[:n]

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """(bucket, segment): classes, pairs and triples of neighbouring classes, marked at the segment's edges."""
        c = self.cls
        before = np.roll(c, 1)
        same = np.zeros(len(c), bool)
        same[1:] = self.seg[1:] == self.seg[:-1]
        before = np.where(same, before, 3)
        before2 = np.where(same & np.roll(same, 1), np.roll(c, 2), 5)
        if len(c) > 1:
            before2[:2] = 5
        mix = lambda *xs: _mixed(xs)
        f = np.concatenate([mix(c), mix(before, c), mix(before2, before, c)])
        s = np.tile(self.seg, 3)
        keep = np.tile(self.body, 3)
        edge = ~self.body & same  # what stands before a line's end
        return np.concatenate([f[keep], mix(before2[edge], before[edge], c[edge])]), np.concatenate([s[keep], self.seg[edge]])

    def repeated(self) -> np.ndarray:
        """By segment, the share of its words that are the word ``lag`` words further on, at the best of the lags 1 to
        ``LAGS``; 0 for fewer than ``LEAST_REPEATED`` words."""
        at = np.flatnonzero(self.word)
        cls, seg = self.cls[at], self.seg[at]
        k = len(self.starts)
        count = np.bincount(seg, minlength=k)
        best = np.zeros(k)
        for lag in range(1, LAGS + 1):
            hit = (cls[lag:] == cls[:-lag]) & (seg[lag:] == seg[:-lag])
            best = np.maximum(best, np.bincount(seg[:-lag][hit], minlength=k) / np.maximum(count - lag, 1))
        return np.where(count >= LEAST_REPEATED, best, 0)

    def lines(self) -> np.ndarray:
        """The number of each token's line."""
        end = ~self.body
        return np.cumsum(end) - end


def _mixed(xs: tuple[np.ndarray, ...]) -> np.ndarray:
    h = np.full(len(xs[0]), 0x9E3779B97F4A7C15 + len(xs), np.uint64)
    for x in xs:
        h = (h ^ x.astype(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return (h & np.uint64(BUCKETS - 1)).astype(np.int64)


#: Weight of the segments around.
AROUND = 0.8


def segment_scores(s: Segments, weights: np.ndarray) -> np.ndarray:
    """Log odds of sentences for each segment.  ``weights`` has a weight for each bucket, then the intercept."""
    f, seg = s.features()
    own = scores(f, seg, len(s.starts), weights)
    # a segment is read with the ones around it: half of its score is that of its neighbours in the text
    size = np.sqrt(s.sums(s.len * s.body))
    near = np.zeros(len(own))
    mass = np.full(len(own), 1e-9)
    for gap in (1, 2):
        if len(own) > gap:
            same = s.doc_of_seg[gap:] == s.doc_of_seg[:-gap]
            for a, b in ((slice(gap, None), slice(None, -gap)), (slice(None, -gap), slice(gap, None))):
                near[a] += own[b] * size[b] * same / gap
                mass[a] += size[b] * same / gap
    return own + AROUND * near / mass


def scores(f: np.ndarray, seg: np.ndarray, k: int, weights: np.ndarray) -> np.ndarray:
    total = np.bincount(seg, weights=weights[f], minlength=k)
    count = np.bincount(seg, minlength=k)
    return weights[-1] + total / np.sqrt(np.maximum(count, 1))


def fit(s: Segments, prose: np.ndarray, out: np.ndarray, steps: int = 40, rate: float = 0.15, decay: float = 3e-4) -> np.ndarray | None:
    """Weights of a logistic model of segments from labels of documents.  Segments marked ``out`` (those of tables and
    lists) are left out; None if what is left is of one kind.

    Each document counts alike, shared among its segments by characters.
    """
    f, seg = s.features()
    k = len(s.starts)
    chars = s.sums((s.len + 1) * (s.body & ~s.blank)) * ~out.astype(bool)
    each = s.by_doc(chars.astype(float), len(prose))
    share = chars / np.maximum(each, 1)[s.doc_of_seg]
    y = prose[s.doc_of_seg].astype(float)
    n1, n0 = (share * y).sum(), (share * (1 - y)).sum()
    if not n1 or not n0:
        return None
    gain = share / (n1 + n0)  # as the labels have them: with both kinds alike, a few wrong labels would weigh as much as all right ones
    norm = 1 / np.sqrt(np.maximum(np.bincount(seg, minlength=k), 1))
    w = np.zeros(BUCKETS + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for i in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(scores(f, seg, k, w), -30, 30)))
        d = gain * (p - y)
        g = np.append(np.bincount(f, weights=(d * norm)[seg], minlength=BUCKETS), d.sum())
        g[:-1] += decay * w[:-1] / BUCKETS
        m = 0.9 * m + 0.1 * g
        v = 0.98 * v + 0.02 * g * g
        w -= rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.98**i)) + 1e-7)
    return w


def parts(text: str, most: int = BATCH) -> list[str]:
    """The text in parts of at most ``most`` characters, parted at line breaks, else blanks, where there are any."""
    out, at = [], 0
    while len(text) - at > most:
        end = max(text.rfind("\n", at, at + most), -1)
        if end <= at:
            end = text.rfind(" ", at, at + most)
        end = at + most if end <= at else end + 1
        out.append(text[at:end])
        at = end
    return [*out, text[at:]]


def batches(texts: list[str], most: int = BATCH):
    """(texts or parts, index of the text of each), again and again, each of few characters."""
    now: list[str] = []
    own: list[int] = []
    size = 0
    for i, x in enumerate(texts):
        for part in parts(x, most):
            if now and size + len(part) > most:
                yield now, np.array(own)
                now, own, size = [], [], 0
            now.append(part)
            own.append(i)
            size += len(part)
    if now:
        yield now, np.array(own)


def known_words(texts: list[str], share: float = 0.003, least: int = 3) -> frozenset[str]:
    """Words in at least ``share`` of the texts: at most (mean distinct words of a text) / share of them."""
    seen: dict[str, int] = {}
    for x in texts:
        for w in {t.lower() for t in TOKEN.findall(x) if t.isalpha()}:
            seen[w] = seen.get(w, 0) + 1
    return frozenset(w for w, n in seen.items() if n >= max(least, share * len(texts)))
