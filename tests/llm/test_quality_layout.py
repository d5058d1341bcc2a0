import random

import numpy as np

from kiosko.llm import layout as L
from kiosko.llm import prose as P
from kiosko.llm import quality as Q

COMMON = frozenset("el la los de en y que un una por con".split())
RULE = Q.Model(None, None, frozenset(), COMMON)


def records(rng, n=10):
    return "\n".join(f"- la ficha de {rng.randint(10, 99)} en el archivo\n  por el ramo: {rng.randint(100, 999)}; un saldo de {rng.randint(1, 9)}; los folios y las cajas del local\nfin, un cierre" for _ in range(n))


def figures(*texts, model=RULE):
    return list(Q.figures(list(texts), model, P.Lexicon(model.known, COMMON)).itertuples())


def test_records_of_three_lines_repeat():
    rng = random.Random(2)
    (r,) = figures(records(rng))
    assert r.alineadas > 0.6 and r.periodicidad == 1 and r.autocorrelacion > 0.8
    assert r.prosa < 0.5  # the rule without labels sees the repetition


def test_gaps_stay_beside_unusual_characters():
    rows = "\n".join(f"{a}   {b}\t{c}" for a, b, c in zip("abcdef", "uvwxyz", "klmnop", strict=True))
    plain, unusual = figures(rows, rows.replace("a", "\N{FULLWIDTH LATIN SMALL LETTER A}"))
    assert plain.alineadas == unusual.alineadas == 1


def test_spans_are_marked_whatever_their_words():
    rng = random.Random(4)
    prose = ["Un vecino de la comuna habló con el consejo.\n" + "Nadie más quiso hablar en la plaza, por la lluvia del lunes.\n" * (1 + i % 3) + f"El alcalde {i} llegó tarde y no dijo nada." for i in range(60)]
    tables = [records(rng, 6) for _ in range(60)]
    s = P.Segments(prose + tables, P.Lexicon(common=COMMON))
    lines = L.Lines(s)
    y = np.arange(120) < 60
    detector = L.fit_detector(lines, y)
    marked = detector.marked(lines)
    assert (marked == ~y[lines.doc]).mean() > 0.97
    assert L.fit_detector(lines, np.ones(120, bool)) is None
    model = Q.Model(detector, np.append(np.zeros(P.BUCKETS), 1.0), frozenset(), COMMON)  # every segment is a sentence
    f = Q.figures([records(rng), prose[2]], model, P.Lexicon(common=COMMON))
    assert f.prosa[0] < 0.5 < f.prosa[1] and f.marcada[0] > 0.5


def test_columns_align_at_a_lag():
    text = "\n".join(f"{'nombre' if i % 2 else 'apellido'}{' ' * (i % 2 * 2)}  | {'x' * (i * 7 % 5 + 1)}" for i in range(10))
    lines = L.Lines(P.Segments([text], P.Lexicon()))
    assert (lines.block[:, L.BLOCK.index("columna")] == 1).all()
