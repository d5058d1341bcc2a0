"""The published Snowball stemmer for Spanish."""

from __future__ import annotations

# Letters and endings of the algorithm.
VOWELS = frozenset("aeiouáéíóúü")
PRONOUNS = "selas selos sela selo las les los nos me se la le lo".split()
BEFORE_PRONOUN = "iéndo ándo ár ér ír ando iendo ar er ir".split()
DELETE_R2 = "anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos osas amiento amientos imiento imientos".split()
DELETE_R2_IC = "adora ador ación adoras adores aciones ante antes ancia ancias".split()
REPLACE_R2 = {"logía": "log", "logías": "log", "ución": "u", "uciones": "u", "encia": "ente", "encias": "ente"}
AFTER_R2 = {"mente": ("ante", "able", "ible"), "idad": ("abil", "ic", "iv"), "idades": ("abil", "ic", "iv"), "iva": ("at",), "ivo": ("at",), "ivas": ("at",), "ivos": ("at",)}
Y_ENDINGS = "yeron yendo yamos yais yan yen yas yes ya ye yo yó".split()
E_ENDINGS = "en es éis emos".split()
VERB_ENDINGS = """
arían arías arán arás aríais aría aréis aríamos aremos ará aré erían erías erán erás eríais ería eréis eríamos eremos erá eré
irían irías irán irás iríais iría iréis iríamos iremos irá iré aba ada ida ía ara iera ad ed id ase iese aste iste an aban ían aran
ieran asen iesen aron ieron ado ido ando iendo ió ar er ir as abas adas idas ías aras ieras ases ieses ís áis abais íais arais
ierais aseis ieseis asteis isteis ados idos amos ábamos íamos imos áramos iéramos iésemos ásemos
""".split()
PLAIN = str.maketrans("áéíóú", "aeiou")


def _after(word: str, start: int) -> int:
    """The place after the first consonant that follows a vowel, from ``start`` on."""
    for i in range(start + 1, len(word)):
        if word[i] not in VOWELS and word[i - 1] in VOWELS:
            return i + 1
    return len(word)


def _verbal(word: str) -> int:
    """Where the region of verb endings begins."""
    if len(word) < 3:
        return len(word)
    first, second = word[0] in VOWELS, word[1] in VOWELS
    if first != second and second:
        return 3
    wanted = not second  # a consonant second letter: after the next vowel; two vowels: after the next consonant
    for i in range(2, len(word)):
        if (word[i] in VOWELS) == wanted:
            return i + 1
    return len(word)


def _ending(word: str, endings, start: int = 0) -> str:
    """The longest of the endings that the word has from ``start`` on, or ''."""
    return max((e for e in endings if word.endswith(e) and len(word) - len(e) >= start), key=len, default="")


def _pronoun(word: str, rv: int) -> str:
    p = _ending(word, PRONOUNS, rv)
    rest = word[: len(word) - len(p)]
    if not p:
        return word
    if before := _ending(rest, BEFORE_PRONOUN, rv):
        return rest[: len(rest) - len(before)] + before.translate(PLAIN)
    return rest if rest.endswith("uyendo") and len(rest) - 5 >= rv else word


def _standard(word: str, r1: int, r2: int) -> str | None:
    """Without a standard suffix; None if there is none to remove."""
    end = _ending(word, [*DELETE_R2, *DELETE_R2_IC, *REPLACE_R2, *AFTER_R2, "amente"])
    at = len(word) - len(end)
    if not end or at < (r1 if end == "amente" else r2):
        return None
    rest = word[:at]
    cut = lambda x, ends: x[: len(x) - len(e)] if (e := _ending(x, ends, r2)) else x
    if end in REPLACE_R2:
        return rest + REPLACE_R2[end]
    if end == "amente":
        shorter = cut(rest, ("iv",))
        return cut(shorter, ("at",)) if shorter != rest else cut(rest, ("os", "ic", "ad"))
    return cut(rest, ("ic",)) if end in DELETE_R2_IC else cut(rest, AFTER_R2.get(end, ()))


def _verb(word: str, rv: int) -> str:
    end = _ending(word, Y_ENDINGS, rv)
    if end and word[: len(word) - len(end)].endswith("u"):
        return word[: len(word) - len(end)]
    end = _ending(word, [*E_ENDINGS, *VERB_ENDINGS], rv)
    if not end:
        return word
    rest = word[: len(word) - len(end)]
    return rest[:-1] if end in E_ENDINGS and rest.endswith("gu") else rest


def stem(word: str) -> str:
    """The stem of a Spanish word in lower case."""
    r1 = _after(word, 0)
    r2, rv = _after(word, r1), _verbal(word)
    word = _pronoun(word, rv)
    shorter = _standard(word, r1, r2)
    word = _verb(word, rv) if shorter is None else shorter
    if end := _ending(word, ("os", "a", "o", "á", "í", "ó", "e", "é"), rv):
        word = word[: len(word) - len(end)]
        if end in "eé" and word.endswith("gu") and len(word) - 1 >= rv:
            word = word[:-1]
    return word.translate(PLAIN)
