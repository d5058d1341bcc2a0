import random
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from kiosko.llm import packing as K


def check_plan(histogram, capacity):
    planned = K.plan(histogram, capacity)
    back = Counter()
    for p, n in planned:
        assert sum(p) <= capacity and n > 0
        for s in p:
            back[s] += n
    assert back == Counter({s: n for s, n in histogram.items() if n})
    return sum(n for _, n in planned)


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(0, 500), max_size=25))
def test_plan_is_a_packing(histogram):
    used = check_plan(histogram, 40)
    room = sum(s * n for s, n in histogram.items())
    halves = sum(n for s, n in histogram.items() if s > 20)
    assert used <= max(2 * -(-room // 40), halves + 1)


def test_little_room_is_left():
    rng = random.Random(1)
    histogram = Counter(min(2048, max(1, int(rng.lognormvariate(5.8, 0.9)))) for _ in range(20_000))
    used = check_plan(histogram, 2048)
    assert 1 - sum(s * n for s, n in histogram.items()) / (used * 2048) < 0.005
    assert check_plan({900: 10**12, 1148: 10**12}, 2048) == 10**12  # the plan doesn't grow with the counts


def check_rows(rows, sizes, capacity):
    filled, pieces = Counter(), defaultdict(list)
    for r in rows:
        filled[r.contenedor] += r.tokens
        pieces[r.doc_id].append((r.desde, r.tokens))
        assert 0 <= r.tokens <= capacity
    assert max(filled.values(), default=0) <= capacity
    for doc, n in sizes.items():
        at = 0
        for start, k in sorted(pieces[doc]):
            assert start == at
            at += k
        assert at == n
        assert len(pieces[doc]) == max(1, -(-n // capacity))
    return filled


def test_rows_hot_size_nulls_and_long_texts(spark):
    rng = random.Random(7)
    sizes = {i: rng.choice([30, 30, rng.randint(0, 100), 100, rng.randint(101, 950)]) for i in range(3000)}
    sizes[2**60] = 12_345
    df = spark.createDataFrame([*sizes.items()], "doc_id bigint, tokens bigint").repartition(5)
    filled = check_rows(K.pack(df, 100, group_rows=200).collect(), sizes, 100)
    assert 1 - sum(sizes.values()) / (len([c for c in filled if filled[c]]) * 100) < 0.02
    odd = spark.createDataFrame([(None, 5), (1, None), (1, 7), (1, 7)], "doc_id bigint, tokens bigint")
    assert sorted((r.doc_id or -1, r.tokens) for r in K.pack(odd, 10).collect()) == [(-1, 5), (1, 0), (1, 7), (1, 7)]
    assert K.pack(df.limit(0), 100).count() == 0


def test_documents(spark):
    rows = [(1, "Hola mundo", "x"), (2**61 + 1, "palabra " * 5000, "x"), (3, "", "x"), (4, None, "x"), (None, "dos", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, contenedor string")
    encode = K.tokenizer(K.TOKENIZER).encode_ordinary
    counts = {r.doc_id: r.tokens for r in K.token_counts(df).collect()}
    assert counts == {i: len(encode(t or "")) for i, t, _ in rows}
    packed = K.packed_documents(df)
    check_rows(packed.collect(), counts, K.CAPACITY)
    report = K.fill_report(packed).first()
    assert report.tokens == sum(counts.values()) and report.contenedores * K.CAPACITY == report.tokens + report.sin_usar


def test_any_capacity():
    rng = random.Random(3)
    for capacity in (4096, 8192):
        histogram = Counter(min(capacity, max(1, int(rng.lognormvariate(6.4, 1.0)))) for _ in range(30_000))
        used = check_plan(histogram, capacity)
        assert used <= -(-sum(s * n for s, n in histogram.items()) // capacity) * 1.003 + 1
    used = check_plan({s: 1000 for s in range(1, 8193)}, 8192)  # every size
    assert used <= 1.002 * 1000 * 8192 * 8193 / 2 / 8192


def test_invariants(spark):
    docs = spark.createDataFrame([(i, "x") for i in range(50)] + [(7, "x")], "doc_id bigint, text string")
    sizes = spark.createDataFrame([(i, 10 + i % 7) for i in range(50)] + [(7, 25)], "doc_id bigint, tokens bigint")
    packed = K.pack(sizes, 20)
    r = K.invariants(docs, packed, 20).first()
    assert (r.textos, r.perdidos, r.mal_divididos, r.excedidos) == (51, 0, 0, 0)
    assert K.invariants(docs, packed.where("doc_id <> 3"), 20).first().perdidos == 1
    assert K.invariants(docs, packed.withColumn("contenedor", packed.contenedor * 0), 20).first().excedidos == 1


def test_null_ids_are_spread(spark):
    df = spark.createDataFrame([(None, 5)] * 300 + [(1, 5)], "doc_id bigint, tokens bigint").repartition(3)
    rows = K.pack(df, 10, group_rows=50).collect()
    assert Counter(Counter(r.contenedor for r in rows).values())[2] == 150
