"""Problem 3: one consistent form for text that looks the same.

Text is brought to one spelling in four steps:

1. invisible characters (zero-width marks, soft hyphens, direction marks, variation selectors) are dropped;
2. presentation forms (full-width, ligature, mathematical, non-breaking) are replaced by the ordinary characters
   they present, judged by the tag of their Unicode decomposition, so that marks with a look of their own
   (superscripts, fractions, ordinal signs) stay;
3. in each token the *resolved script sets* of its letters are intersected: a letter's set holds its own script and
   each script that has a look-alike of it.  An empty or single-script result shows a mixed token, a result of
   several scripts a whole-script confusable; the spelling in the consistent script (for whole-script confusables
   the script of the rest of the text) is selected;
4. accents are composed and white space is trimmed and squeezed.

Case, visible accents, punctuation and wording are never changed.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiosko.plans.common import joined, written

# Letters of other scripts and the Latin letter that looks the same.
CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТУХҮѴԚԜԌӀасеѕіјорухһԁԛԝӏүѵ", "ABESIJKMHOPCTYXYVQWGIacesijopyxhdqwlyv", strict=True))
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϺͿϳοανρυιγϲ", "ABEZHIKMNOPTYXCMJjoavpuiyc", strict=True))
ARMENIAN = dict(zip("ՕՏՍԼօոսհցյզ", "OSULonuhgjq", strict=True))
CHEROKEE = dict(zip("ᎪᏴᏟᎠᎬᎻᎫᏦᏞᎷᏢᎡᏚᎢᏙᎳᏃᎥᎩᏀᏂᏏᏒᏔᏕᏧᏳꭵꮃꮓꮩꮪꮯ", "ABCDEHJKLMPRSTVWZiYGhbRWSdGiwzvsc", strict=True))
CANADIAN = dict(zip("ᐯᑌᑭᑯᑲᒍᒪᕁᕼᕽᖇᖯᖴᗅᗞᗪᗰᗷ", "VUPdbJLxHxRbFADDMB", strict=True))
COPTIC = dict(zip("ⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⳐⲟⲣⲥ", "HIKMNOPCTYXLopc", strict=True))
LISU = dict(zip("ꓐꓑꓒꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPdDTGKJCZFMNLSRVHWXYAEIOU", strict=True))
LATIN = dict(zip("ɑɡɩꞮᴄᴏꜱᴜᴠᴡᴢ", "agiIcosuvwz", strict=True))
# Punctuation and blanks, and the ordinary character that looks the same.
MARKS = dict(zip("\u2010\u2212\u02d7\u02bc\ua78c\u2236\ua4fd\ua4f8\ua4f9\u2215\u2044\u2223\u01c0\u01c3\u2800", "---’'::.,//||! ", strict=True))

SCRIPTS = {"Cyrillic": CYRILLIC, "Greek": GREEK, "Armenian": ARMENIAN, "Cherokee": CHEROKEE, "Canadian": CANADIAN, "Coptic": COPTIC, "Lisu": LISU}
#: Latin letter -> the look-alike of each other script.
BACK = {s: {v: k for k, v in reversed(list(t.items()))} for s, t in SCRIPTS.items()}
TO_LATIN = {k: v for t in SCRIPTS.values() for k, v in t.items()}
COMPAT = {"<wide>", "<narrow>", "<noBreak>", "<font>", "<compat>", "<initial>", "<medial>", "<final>", "<isolated>"}
# Default-ignorable characters outside of category Cf.
IGNORABLE = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10)}
JOINERS = "‌‍"

# Graphic characters that stay as they are.
_STABLE = "!-~¡-¬®-´¶-ÿ–—‘’“”€"
#: What text must hold to be changed at all: another character, or white space that isn't one blank between words.
#: Searches for single characters, in a syntax that Java and Python share, so no text is too long for them.
UNSTABLE_TITLE = f"[^ {_STABLE}]|^ | $|  "
#: The same for texts of several lines, whose white space doesn't matter.
UNSTABLE_TEXT = f"[^ \n\t{_STABLE}]"
_unstable_title = re.compile(UNSTABLE_TITLE)
_unstable_text = re.compile(UNSTABLE_TEXT)
_token = re.compile(r"[^\W\d_](?:[^\W_]|[̀-ͯ])*")


#: Articles of one spelling that a task pairs with as many of another.
CHUNK = 2000


@lru_cache(maxsize=1 << 16)
def _script(ch: str) -> str:
    if ch < "ɐ":
        return "Latin"
    first = unicodedata.name(ch, "").partition(" ")[0].capitalize()
    return first or "Unknown"


@lru_cache(maxsize=1 << 16)
def _presented(ch: str) -> str:
    """The ordinary characters, decomposed, that a single character presents."""
    if ch in MARKS:
        return MARKS[ch]
    tag, _, rest = unicodedata.decomposition(ch).partition(" ")
    if tag in COMPAT and ch not in TO_LATIN:
        plain = "".join(chr(int(x, 16)) for x in rest.split())
        if len(plain) > 1 and plain[0] == " " and unicodedata.combining(plain[1]):
            return ch  # a free-standing accent is visible
        return "".join(_presented(x) for x in plain)
    if unicodedata.category(ch) == "Zs":
        return " "
    return ch if ch in TO_LATIN else unicodedata.normalize("NFD", ch)


@lru_cache(maxsize=1 << 16)
def _invisible(ch: str) -> bool:
    return unicodedata.category(ch) == "Cf" and not 0x0600 <= ord(ch) <= 0x08FF or ord(ch) in IGNORABLE or 0xE0000 <= ord(ch) <= 0xE0FFF


def _shown(text: str) -> str:
    """Without invisible characters; joiners stay in scripts where they change the look of letters."""
    if not any(map(_invisible, set(text))):
        return text
    out: list[str] = []
    for ch in text:
        if _invisible(ch):
            prev = out[-1] if out else " "
            if not (ch in JOINERS and prev >= "֐" and unicodedata.category(prev)[0] in "LMS" and not "＀" <= prev <= "￯"):
                continue
        out.append(ch)
    return "".join(out)


def _scripts_of(ch: str) -> frozenset[str]:
    """The resolved script set: the scripts in which a letter of this look exists."""
    own = _script(ch)
    latin = ch if own == "Latin" else TO_LATIN.get(ch)
    if latin is None:
        return frozenset([own])
    return frozenset([own, "Latin", *(s for s, t in BACK.items() if latin in t)])


_scripts_of = lru_cache(maxsize=1 << 16)(_scripts_of)


def _spelled(token: str, script: str) -> str:
    out = []
    for ch in token:
        latin = TO_LATIN.get(ch, ch)
        if script == "Latin":
            out.append(latin)
        elif _script(ch) == script or script not in BACK:
            out.append(ch)
        else:
            out.append(BACK[script].get(latin, ch))
    return "".join(out)


def _resolve(token: str, around: str) -> str:
    """The consistent spelling of a token in a text most of which the script ``around`` can spell."""
    letters = [c for c in token if c.isalpha()]
    if not letters:  # a numeral such as a superscript
        return token
    common = frozenset.intersection(*map(_scripts_of, letters))
    if common:  # the token can be spelled in one script throughout
        if len(common) == 1:
            return _spelled(token, next(iter(common)))
        own = {_script(c) for c in letters}
        if around in common:
            return _spelled(token, around)
        return _spelled(token, "Latin" if len(own) > 1 or own <= {"Latin"} else own.pop())
    # no script has all letters: those that several have are spelled in the surrounding script, for that leaves the
    # fewest scripts; only where it lacks them in the script of most of the fixed ones
    fixed = Counter(s for c in letters for s in _scripts_of(c) if len(_scripts_of(c)) == 1)
    other = min(fixed, key=lambda s: (-fixed[s], s)) if fixed else around
    return "".join(_spelled(c, around if around in own else other) if c.isalpha() and ((own := _scripts_of(c)) & {around, other}) else c for c in token)


def consistent(text: str | None, lines: bool = False, layout: bool = False) -> str | None:
    """The consistent form of a text; ``lines`` keeps its line breaks, ``layout`` all white space besides (no-break
    and other blanks as blanks).  None gives None."""
    if text is None or not (_unstable_text if lines or layout else _unstable_title).search(text):
        return text
    text = _shown("".join(map(_presented, text)))
    if any(c in LATIN for c in set(text)):
        text = "".join(LATIN.get(c, c) for c in text)
    text = re.sub("ı(?=[̀-̔])", "i", text)  # a dotless i below an accent
    if not text.isascii() and any(_script(c) != "Latin" for c in set(text) if c.isalpha()):
        tokens = _token.findall(text)
        # the script that can spell most letters: the same for every disguise of a text
        seen = Counter(s for t in tokens for c in t if c.isalpha() for s in _scripts_of(c))
        around = min(seen, key=lambda s: (-seen[s], s != "Latin", s)) if seen else "Latin"
        text = _token.sub(lambda m: m[0] if m[0].isascii() and around == "Latin" else _resolve(m[0], around), text)
    text = unicodedata.normalize("NFC", text)
    if layout:
        return text
    if lines:
        return "\n".join(" ".join(x.split()) for x in text.split("\n"))
    return " ".join(text.split())


@F.pandas_udf(T.StringType())
def _consistent_udf(s: pd.Series) -> pd.Series:
    return s.map(consistent, na_action="ignore")


def consistent_column(col: Column) -> Column:
    """``consistent`` of a column.  All rows pass the Python stage, but only values that may change with their text: all
    others are null there, and the JVM keeps them."""
    unstable = col.rlike(f"[^ {_STABLE}]") | col.startswith(" ") | col.endswith(" ") | col.contains("  ")
    return F.when(unstable, _consistent_udf(F.when(unstable, col))).otherwise(col)


def articles(noticias: DataFrame, *cols: str) -> DataFrame:
    """One row per distinct non-null ``id``.  Rows of an article agree in all but their arrival; ``min`` makes the
    choice among rows that don't agree defined and is combined before the shuffle."""
    return noticias.where(F.col("id").isNotNull()).groupBy("id").agg(*(F.min(c).alias(c) for c in cols))


def consistent_titles(noticias: DataFrame) -> DataFrame:
    """(id, titulo, forma): each article's title and its consistent form.  Null titles keep a null form; blank ones
    become empty."""
    return articles(noticias, "titulo").withColumn("forma", consistent_column(F.col("titulo")))


def _spelled_forms(own: DataFrame) -> DataFrame:
    """(forma, titulo, n): the spellings of each form and their articles, as a table."""
    return written(own.groupBy("forma", "titulo").agg(F.count("*").alias("n")))


def _hashed(text: str) -> list[Column]:
    """Two 64-bit hashes by which a small side of a join names a text, so that its rows are short whatever the texts are."""
    return [F.xxhash64(text).alias("_h"), F.xxhash64(F.lit(1), text).alias("_g")]


def lookalike_classes(noticias: DataFrame) -> DataFrame:
    """(id, clase, grafias, enlaces) of every article with a non-blank title: its class is the least id of the articles
    whose titles read the same, ``grafias`` the number of different strings in the class, ``enlaces`` the number of its
    articles whose string is another than this one's.  One row an article, however many copies there are."""
    own = written(consistent_titles(noticias).where(F.col("forma") != ""))
    spelled = own.groupBy("forma", "titulo").agg(F.count("*").alias("n"), F.min("id").alias("clase"))
    forms = spelled.groupBy("forma").agg(F.min("clase").alias("clase"), F.count("*").alias("grafias"), F.sum("n").alias("todos"))
    by_title = written(spelled.drop("clase").join(forms, "forma").select(*_hashed("titulo"), "n", "clase", "grafias", (F.col("todos") - F.col("n")).alias("enlaces")))
    return joined(own.select("id", *_hashed("titulo")), by_title, ["_h", "_g"], "n").select("id", "clase", "grafias", "enlaces")


def lookalike_pairs(noticias: DataFrame) -> DataFrame:
    """(id_a, id_b), id_a < id_b: articles with non-blank titles of one consistent form but different strings.

    Only forms written in two ways or more go on.  Their *spellings* are paired, and the articles of a spelling are parted
    into chunks of about ``CHUNK``; each pair of chunks meets by itself, so no title is a hot key, and equal strings are
    never compared with one another.  ``lookalike_classes`` says the same in one row an article.
    """
    own = written(consistent_titles(noticias).where(F.col("forma") != ""))  # once, for it is read several times
    several = own.groupBy("forma").agg(F.min("titulo").alias("lo"), F.max("titulo").alias("hi"), F.count("*").alias("n")).where("lo <> hi")
    own = written(joined(own.select("*", *_hashed("forma")), written(several.select(*_hashed("forma"), "n")), ["_h", "_g"], "n").select("forma", "titulo", "id"))
    spelled = _spelled_forms(own).withColumn("k", F.ceil(F.col("n") / CHUNK).cast("int"))
    ids = joined(own.select("titulo", "id", *_hashed("titulo")), spelled.select(*_hashed("titulo"), "n", "k"), ["_h", "_g"], "n").select("titulo", F.pmod(F.xxhash64("id"), "k").cast("int").alias("c"), "id")
    side = lambda x: spelled.select("forma", F.col("titulo").alias(f"t_{x}"), F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias(f"c_{x}"))
    pairs = written(side("a").join(side("b"), "forma").where("t_a < t_b").drop("forma"))
    keys = ["t_a", "c_a", "t_b", "c_b"]
    one = lambda x: pairs.join(ids.select(F.col("titulo").alias(f"t_{x}"), F.col("c").alias(f"c_{x}"), F.col("id").alias(f"id_{x}")), [f"t_{x}", f"c_{x}"]).select(*keys, f"id_{x}")
    return one("a").join(one("b"), keys).select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))
