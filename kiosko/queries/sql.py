"""Fragments of the SQL that says the same as the text functions."""

from __future__ import annotations

from kiosko.functions import dictionaries as D
from kiosko.functions import text as X


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def listed(xs) -> str:
    return "[" + ", ".join(map(quoted, xs)) + "]"


def inside(xs) -> str:
    return "(" + ", ".join(map(quoted, xs)) + ")"


def mapped(d: dict[str, str]) -> str:
    return f"MAP({listed(d)}, {listed(d.values())})"


STOP = listed(sorted(D.STOPWORDS))

#: The articles: one row an id.
ART = """art AS (SELECT id, min(titulo) AS titulo, min(fuente) AS fuente, min(fecha) AS fecha, min(url) AS url, min(bajada) AS bajada
  FROM noticias WHERE id IS NOT NULL GROUP BY id)"""


def replaced(x: str, *pairs: tuple[str, str]) -> str:
    for pattern, by in pairs:
        x = f"regexp_replace({x}, {quoted(pattern)}, {quoted(by)}, 'g')"
    return x


def ngram_profile(x: str) -> str:
    return f"trim({replaced(f'nfc_normalize(lower({x}))', (r'[\x{2010}-\x{2015}]', ' '), ('&[a-z0-9]+;', ' '), ('&#[0-9]+;', ' '), (r'[\p{P}\p{S}]', ' '), (r'\p{Nd}', ' '), (r'[\s\v\p{Z}]+', ' '))})"


def term_profile(x: str) -> str:
    return replaced(f"nfc_normalize(lower({x}))", (r"[\x{2010}-\x{2015}]", "-"), ("&[a-z0-9]+;", " "), ("&#[0-9]+;", " "), ("[\"']", " "))


def kept_tokens(x: str) -> str:
    return f"list_filter(regexp_extract_all({x}, '[\\p{{L}}\\p{{M}}\\p{{N}}_]+'), lambda x: length(x) >= 3 AND regexp_matches(x, '[a-zA-ZñáéíóúüÑÁÉÍÓÚÜ]') AND NOT list_contains({STOP}, x))"


def renamed(x: str, table: dict[str, str]) -> str:
    return f"list_transform({x}, lambda x: coalesce(map_extract({mapped(table)}, x)[1], x))"


def fused(x: str, patterns: dict[tuple[str, ...], str]) -> str:
    marked = f"array_to_string(list_transform({x}, lambda x: '<' || x || '>'), '')"
    names = mapped({"".join(f"<{w}>" for w in p): n for p, n in patterns.items()})
    return f"list_transform(regexp_extract_all({marked}, {quoted(X.fusion_regex(patterns))}), lambda x: coalesce(map_extract({names}, x)[1], regexp_replace(x, '[<>]', '', 'g')))"


def hyphens(x: str) -> str:
    part = "[a-zñáéíóúü]{3,}"
    return f"list_filter({x}, lambda x: NOT contains(x, '-') OR regexp_full_match(x, '{part}-{part}'))"


def fused_by(x: str, regex: str, names: str) -> str:
    """The same by a regular expression and a map that columns hold."""
    marked = f"array_to_string(list_transform({x}, lambda x: '<' || x || '>'), '')"
    return f"list_transform(regexp_extract_all({marked}, {regex}), lambda x: coalesce(map_extract({names}, x)[1], regexp_replace(x, '[<>]', '', 'g')))"


def terms(x: str, pairs: bool = False) -> str:
    return canonical(fused(kept_tokens(term_profile(x)), D.compounds(pairs)), pairs)


def canonical(fused_tokens: str, pairs: bool = False) -> str:
    out = renamed(fused_tokens, D.hyphens())
    return hyphens(renamed(out, D.singles())) if pairs else renamed(renamed(hyphens(out), D.singles()), D.lemmas())


#: One row a term of a title.
TERMS = f"""{ART}, tok AS (SELECT id, fecha, fuente, {terms("titulo")} AS toks FROM art WHERE trim(titulo) <> ''),
  term AS (SELECT id, fecha, fuente, t.termino FROM tok, unnest(toks) AS t(termino) WHERE length(t.termino) <= 150)"""

#: One row a 2-gram or 3-gram of a title.
GRAMS = f"""{ART}, w AS (SELECT id, fecha, fuente, list_filter(string_split({ngram_profile("titulo")}, ' '), lambda x: x <> '') AS w FROM art WHERE trim(titulo) <> ''),
  g AS (SELECT id, fecha, fuente, tipo, w[i:i + tipo - 1] AS parts FROM w, (VALUES (2), (3)) v(tipo), unnest(generate_series(1, len(w) - tipo + 1)) AS s(i)),
  gram AS (SELECT id, fecha, fuente, array_to_string(parts, ' ') AS ngrama, tipo FROM g
    WHERE len(list_filter(parts, lambda x: length(x) < 3 OR list_contains({STOP}, x))) = 0 AND length(array_to_string(parts, ' ')) <= 300)"""

#: One row a pair of terms of a title.
PAIRS = f"""{ART}, tok AS (SELECT id, fecha, fuente, list_distinct({terms("titulo", True)}) AS toks FROM art WHERE trim(titulo) <> ''),
  one AS (SELECT id, fecha, fuente, t.t AS t FROM tok, unnest(toks) AS t(t) WHERE length(t.t) <= 150),
  pair AS (SELECT a.id, a.fecha, a.fuente, a.t AS termino_a, b.t AS termino_b FROM one a JOIN one b ON a.id = b.id AND a.t < b.t)"""

#: One result an article.
TONE = """tone AS (SELECT id, x.sentimiento AS sentimiento, x.procesado_en AS procesado_en, x.modelo AS modelo, x.confianza AS confianza FROM (
    SELECT id, procesado_en, lower(trim(sentimiento)) AS sentimiento, modelo, confianza, prompt_version,
      row_number() OVER (PARTITION BY id ORDER BY procesado_en DESC NULLS LAST, lower(trim(sentimiento)) DESC, modelo DESC NULLS LAST, confianza DESC NULLS LAST, prompt_version DESC NULLS LAST) AS r
    FROM noticias_sentimiento WHERE id IS NOT NULL AND lower(trim(sentimiento)) IN ('positivo', 'neutral', 'negativo')) x WHERE r = 1)"""
