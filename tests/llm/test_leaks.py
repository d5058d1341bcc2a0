import random
from collections import defaultdict

from kiosko.llm import leaks as L
from kiosko.llm.consistent import consistent


def words(rng, n):
    return ["".join(rng.choice("abcdeíñó") for _ in range(rng.randint(2, 5))) for _ in range(n)]


def corpus():
    rng = random.Random(9)
    items = [(i, " ".join(words(rng, rng.randint(11, 60)))) for i in range(20)]
    items += [(100, items[0][1]), (101, None), (102, "corta")]
    docs = []
    for d in range(120):
        text = words(rng, rng.randint(0, 50))
        if d % 3 == 0:
            own = items[rng.randrange(20)][1].split()
            k = rng.randint(9, 30)
            at = rng.randrange(max(1, len(own) - k))
            part = own[at : at + k]
            cut = rng.randint(0, len(text))
            text[cut:cut] = [w.upper() if rng.random() < 0.3 else w.replace("a", "а") for w in part]
        docs.append((d, rng.choice([" ", ", ", "\n", "  "]).join(text)))
    return [*docs, (500, None), (501, ""), (None, items[1][1]), (7, items[2][1])], items


def brute(docs, items, least=12):
    grams = defaultdict(set)
    for i, x in items:
        w = L.plain_words(consistent(x, True) or "")
        for j in range(len(w) - least + 1):
            grams[tuple(w[j : j + least])].add(i)
    out = set()
    for d, x in docs:
        w = L.plain_words(consistent(x, True) or "")
        for j in range(len(w) - least + 1):
            out |= {(d, i) for i in grams.get(tuple(w[j : j + least]), ())}
    return out


def test_against_brute_force(spark):
    docs, items = corpus()
    documents = spark.createDataFrame([(*d, 1.0) for d in docs], "doc_id bigint, text string, cobertura double").repartition(3)
    stated = spark.createDataFrame([(*i, "t") for i in items], "item_id bigint, text string, doc_id string")
    want = {p for p in brute(docs, items) if p[0] is not None}
    assert want
    for block in (1 << 20, 500):
        got = [(r.doc_id, r.item_id) for r in L.leaks(documents, stated, block_chars=block).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert L.leaked_documents(documents.limit(0), stated).count() == 0
    assert L.leaked_documents(documents, stated.limit(0)).count() == 0


def test_reordered_passages_are_covered():
    rng = random.Random(1)
    item = words(rng, 60)
    text = " ".join([*words(rng, 20), *item[30:60], *words(rng, 3), *item[:30], *words(rng, 5)])
    index = L.Index([(1, " ".join(item))])
    ((_, _, share, longest, n),) = L.found([text], index, L.Chunks(index.number))
    assert (share, longest, n) == (1.0, 30, 2)


def test_tiles_overlap_nothing():
    import numpy as np

    doc, item = np.array(list(b"abcabcxabcab")), np.array(list(b"abcabcabcabcabc"))
    p, q = np.array([(p, q) for p in range(len(doc) - 2) for q in range(13) if (doc[p : p + 3] == item[q : q + 3]).all() and (p == 0 or q == 0 or doc[p - 1] != item[q - 1])]).T
    n = L.lengths(doc, item, p, q, np.minimum(len(doc) - p, len(item) - q), 3)
    for i, j, k in zip(p, q, n, strict=True):
        assert (doc[i : i + k] == item[j : j + k]).all() and (i + k == len(doc) or j + k == len(item) or doc[i + k] != item[j + k])
    marked = L.tiles(doc, item, p, q, n, 3)
    for side in (0, 1):
        used = [x + j for t in marked for x, j in [(t[side], j) for j in range(t[2])]]
        assert len(used) == len(set(used))
    assert sum(t[2] for t in marked) == 11


def test_a_very_long_text():
    rng = random.Random(2)
    item = words(rng, 20)
    index = L.Index([(1, " ".join(item))])
    text = " ".join([*words(rng, 1000) * 300, *item, *words(rng, 10)])
    assert [x[:2] for x in L.found([text, "nada"], index, L.Chunks(index.number))] == [(0, 0)]


def test_a_phrase_that_both_repeat_gives_few_matches(monkeypatch):
    import numpy as np

    monkeypatch.setattr(L, "PAIRS", 1000)
    index = L.Index([(1, "no " * 3000), (2, "uno " + "no " * 500 + "dos")])
    text = "si " + "no " * 20_000 + "fin"
    ids, ends = L.encode([text], L.Chunks(index.number))
    assert {x[1]: x[3] for x in L.found([text], index, L.Chunks(index.number))} == {0: 3000, 1: 500}
    whole = np.arange(1, 19_990)
    h = L._hashes(ids, 12)[whole]
    assert len(L._met(index, ids, ends, whole, h)[0]) < 60_000  # of 70 million pairs


def test_short_passages_in_another_order(spark):
    rng = random.Random(5)
    item = words(rng, 64)
    pieces = [item[i : i + 8] for i in range(0, 64, 8)]
    rng.shuffle(pieces)
    text = " ".join(w for p in pieces for w in [*p, "zz", "yy"])
    docs = spark.createDataFrame([(1, text), (2, " ".join(pieces[0]))], "doc_id bigint, text string")
    stated = spark.createDataFrame([(9, " ".join(item))], "item_id bigint, text string")
    assert L.leaked_documents(docs, stated).count() == 0
    (r,) = L.leaks(docs, stated, L.LEAST_TILE, L.COVERAGE).collect()
    assert (r.doc_id, r.item_id) == (1, 9) and r.cobertura == 1.0
