import itertools
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from kiosko.llm import consistent as C
from kiosko.plans import common


def test_same_look():
    want = "Última actualización: sequía en Ñanteo, según el país"
    cases = [
        "Últimа асtuаlіzасіóп: sequía en Ñanteo, según el país".replace("п", "n"),  # Cyrillic
        "Ｕ́ltima ａｃｔｕａｌｉｚａｃｉóｎ： sequía en Ñanteo， según el país",
        "Ul​tima".replace("U", "Ú") + " actualiza­ción: sequía en Ñanteo, ﻿según el país ",
        unicodedata.normalize("NFD", want),
        "Últimα".replace("α", "ɑ") + " actualizaciοn: sequía en Ñanteo, según el país".replace("οn", "όn"),  # Greek
    ]
    for x in cases:
        assert C.consistent(x) == want, x


def test_whole_script_words():
    assert C.consistent("robo en Lonitruma «мир»") == "robo en Lonitruma «мир»"
    assert C.consistent("robo en Lonitruma «миp»") == "robo en Lonitruma «мир»"  # a Latin p among Cyrillic letters
    assert C.consistent("hablа о у са еn el рaís") == "habla o y ca en el país"
    assert C.consistent("он и она") == "он и она"  # a text in Cyrillic stays
    assert C.consistent("Αθήνα και Ρόδος") == "Αθήνα και Ρόδος"


def test_visible_differences_stay():
    titles = ["Robo en Lota", "ROBO EN LOTA", "Robó en Lota", "Robo en Lota.", "Robo en Iota", "Robo 2º", "Robo 2o", "Robo 2°", "Robo m²", "Robo m2", "½", "«Robo»", '"Robo"', "´a", "a"]
    assert len({C.consistent(t) for t in titles}) == len(titles)


def test_letters_and_marks_of_many_blocks():
    for x, want in (
        ("ꓡota", "Lota"), ("ᴄobre", "cobre"), ("ꮯasa", "casa"), ("ⲟla", "ola"), ("a\u2010b", "a-b"), ("3\u22122", "3-2"), ("d\u02bcor", "d’or"), ("10\u223630", "10:30"), ("a\u2800b", "a b"),
    ):
        assert C.consistent(x) == want, x


def test_a_token_that_no_script_has_keeps_the_letters_of_its_surroundings():
    assert C.consistent("κilo de pan") == "κilo de pan"
    assert C.consistent("κіlо de pan") == "κilo de pan"  # Cyrillic і and о
    assert C.consistent("он κилo") == C.consistent("он κило")


def test_joiners_stay_where_they_shape_letters():
    assert C.consistent("می‌خواهم") == "می‌خواهم"
    assert C.consistent("ro‌bo") == "robo"


def test_edges():
    assert C.consistent(None) is None and C.consistent("") == "" and C.consistent(" ​ ") == ""
    assert C.consistent("a b\n\n c", lines=True) == "a b\n\nc"
    assert len(C.consistent("ｐａｌａｂｒａ " * 200_000)) == 8 * 200_000 - 1


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_idempotent(x):
    once = C.consistent(x)
    assert C.consistent(once) == once


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abcdeñíóúopxyKMT «»:.,", max_size=30), st.randoms())
def test_disguises_are_found(x, rng):
    plain = C.consistent(x)
    back = {v: k for k, v in C.CYRILLIC.items()}
    disguised = "".join(back.get(c, c) if rng.random() < 0.4 else c for c in unicodedata.normalize("NFD", plain))
    assert C.consistent(disguised.replace(" ", " ")) == plain


def test_pairs_against_brute_force(spark, monkeypatch):
    base = ["Robo en Lota", "Rоbo en Lota", "Robo en Lota", "ROBO EN LOTA", "Otra cosa", "", None, "​"]
    rows = [(f"id{i:03d}", base[i % len(base)], "extra", 1) for i in range(120)] + [("id000", base[0], "extra", 1), (None, base[1], "x", 1)]
    df = spark.createDataFrame(rows, "id string, titulo string, forma string, lo int")
    own = {i: t for i, t, *_ in rows if i}
    form = {i: C.consistent(t) for i, t in own.items()}
    want = {(a, b) for a, b in itertools.combinations(sorted(own), 2) if form[a] and form[a] == form[b] and own[a] != own[b]}
    got = [tuple(r) for r in C.lookalike_pairs(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert C.lookalike_pairs(df.limit(0)).count() == 0
    titles = {r.id: r.forma for r in C.consistent_titles(df).collect()}
    assert titles == form
    monkeypatch.setattr(C, "CHUNK", 3)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(common, "HOT_ROWS", 25)
    again = [tuple(r) for r in C.lookalike_pairs(df).collect()]
    assert len(again) == len(set(again)) and set(again) == want
    classes = {r.id: (r.clase, r.grafias, r.enlaces) for r in C.lookalike_classes(df).collect()}
    alike = {i: [j for j in own if form[i] and form[j] == form[i]] for i in own}
    assert classes == {i: (min(js), len({own[j] for j in js}), sum(own[j] != own[i] for j in js)) for i, js in alike.items() if js}
    assert C.lookalike_classes(df.limit(0)).count() == 0
