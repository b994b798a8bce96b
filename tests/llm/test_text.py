"""Operators 11 to 13 against brute force, on edge cases and on the small tables."""

import random

import pytest
from pyspark.sql import functions as F

from flowlens.llm import convtrie, katz, spelling
from flowlens.llm import registry as R
from flowlens.llm.common import table
from tests.llm import brute_text as brute
from tests.llm.test_exact import docs, rows, texts


def words(rng, n, alphabet="abcé", size=(4, 7)):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(*size))) for _ in range(n))


@pytest.fixture(scope="module")
def empty(spark):
    return docs(spark, []).limit(0)


# ----------------------------------------------------------------- op 11
def spelt(df, **limits):
    return rows(spelling.variants(df, **limits).select("word", "form", "root", "n", "n_near", "form_n"))


def test_spelling_small_table(spark, sf_dir):
    src = texts(table(spark, sf_dir, "documents"))
    got = rows(R.op11_spelling(spark, sf_dir).select("word", "form", "root", "n", "n_near", "form_n"))
    assert got == brute.spelling(src) and any(k[1] for k in got)


@pytest.mark.parametrize("seed", range(3))
def test_spelling_random_words(spark, seed):
    """Few letters, so that repeated letters, chains of forms and ties abound; words with accents and capitals."""
    rng = random.Random(seed)
    pairs = [(i, words(rng, rng.randint(1, 400), "aab" if i % 2 else "ABé", (3, 6 + seed))) for i in range(40)]
    got = spelt(docs(spark, pairs).repartition(7))
    assert got == brute.spelling(pairs) and any(k[2] != k[1] for k in got if k[1])


def test_spelling_odd_rows(spark, empty):
    long = "y" * 3000
    pairs = [(1, None), (2, ""), (None, "letter letters letter"), (None, "letter lettter"), (5, "Letter LETTER lettre × ÷ Àletter"), (6, "letter6letter_letter-lettér"),
             (7, long), (8, long + "y"), (9, f"{long} {long}y {long} {long}y"), (-3, "漢字letter😀 letters letters lettér lettér"), (9, "letters"), (9, "letters")]
    assert spelt(docs(spark, pairs), every=3) == brute.spelling(pairs, every=3)
    assert spelt(docs(spark, pairs), every=2, length=1, count=1, held=2) == brute.spelling(pairs, every=2, length=1, count=1)
    assert spelt(empty) == {}


def test_trie_numbers_are_those_of_prefixes(spark):
    """Equal prefixes have equal numbers and others do not, over many ranges."""
    rng = random.Random(9)
    keys = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(300)} | {"a" * 40, "a" * 41, "a" * 60})
    df = spark.createDataFrame([(k, n) for n, k in enumerate(keys)], "key string, payload long")
    number = {}
    got = spelling.trie(df, "test").collect()
    assert len({r["part"] for r in got}) > 4 and [r["key"] for r in sorted(got, key=lambda r: r["at"])] == keys
    for r in got:
        for d, node in enumerate(r["path"]):
            assert number.setdefault(r["key"][:d], node) == node
    assert len(set(number.values())) == len(number)


# ----------------------------------------------------------------- op 12
CONV = "turn long, conv_id long, role string, text string, depth int, part int, Trie string"


def conversations(spark, items):
    return spark.createDataFrame([(t, c, r, x, 1, 2, "z") for c, t, r, x in items], CONV)


def trie_rows(df):
    return rows(df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"))


def random_talk(seed, convs=60, length=12, texts=2):
    rng = random.Random(seed)
    out = []
    for c in range(-10, convs):
        for t in range(rng.randint(1, length)):
            out.append((c, rng.choice([None, t, t, t]), rng.choice("ab"), rng.choice(["x", "yé", None][:texts + 1])))
    rng.shuffle(out)
    return out


def test_conversation_trie_small_table(spark, sf_dir):
    src = [tuple(r) for r in table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert trie_rows(R.op12_conversation_trie(spark, sf_dir)) == brute.conversation_trie(src)


@pytest.mark.parametrize("seed,chunk,segment", [(1, 10_000, 1024), (2, 3, 1024), (3, 1, 1024), (4, 2, 4), (5, 7, 2), (6, 1000, 1)])
def test_conversation_trie_random(spark, seed, chunk, segment):
    """Small forests and segments, so that nodes span many borders and tries many segments."""
    items = random_talk(seed, convs=40 + 30 * (seed % 3), texts=1 + seed % 2)
    got = trie_rows(convtrie.prefix_trie(conversations(spark, items).repartition(5), segment=segment, chunk=chunk, ids=2))
    assert got == brute.conversation_trie(items)


def test_conversation_trie_odd_rows(spark):
    items = [(None, 1, "a", "x"), (3, 1, None, None), (3, 1, None, None), (3, None, "a", ""), (4, 2, "user", "y" * 50_000), (10**15, 1, "a", "b"), (-7, 0, "é", "漢")]
    got = convtrie.prefix_trie(conversations(spark, items))
    assert trie_rows(got) == brute.conversation_trie(items)
    assert convtrie.prefix_trie(conversations(spark, items).limit(0)).isEmpty()


def test_one_conversation_with_most_turns_and_many_copies(spark):
    """A conversation longer than many segments, twice; and hundreds of equal ones."""
    long = [(c, t, "a", f"{t % 3}") for c in (10, 11) for t in range(700)]
    items = long + [(c, t, "b", "same") for c in range(100, 400) for t in range(2)]
    got = convtrie.prefix_trie(conversations(spark, items).repartition(6), segment=16, chunk=8, ids=8)
    assert trie_rows(got) == brute.conversation_trie(items)


# ----------------------------------------------------------------- op 13
COLUMNS = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def scores(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[6]))


def check(got, pairs):
    model, want = brute.katz(pairs)
    want.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[6]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)
    return model


def test_katz_small_table(spark, sf_dir):
    model = check(scores(R.op13_katz(spark, sf_dir)), texts(table(spark, sf_dir, "documents")))
    assert model.star(1) < 0.9


@pytest.mark.parametrize("size", [50, 400, 10**6])
def test_katz_random_texts(spark, size):
    """Many blocks and buckets; contexts that only frequent words follow; words that only held-out texts have."""
    rng = random.Random(size)
    common = [w * 3 for w in "abcd"]
    pairs = [(i, " ".join(rng.choice([rng.choice(common), rng.choice(common), "q" + str(int(rng.expovariate(0.1))), "never" + str(i)]) for _ in range(rng.randint(0, 40)))
              + (" only this" if i % 2 else "")) for i in range(200)]
    model, want = brute.katz(pairs)
    learns = ~katz.held_out(F.col("doc_id"))
    got = katz.katz(docs(spark, pairs).repartition(3), learns, size=size).withColumn("held_out", ~F.col("learns"))
    check(scores(got), pairs)
    assert any(model.context(v)[0] > model.contexts[v] for v in list(model.contexts))
    for v in [*list(model.contexts)[:50], "new"]:
        total = sum(model.prob(w, v) for w in model.words) + model.prob("never seen", v)
        assert total == pytest.approx(1)


def test_katz_odd_rows(spark, empty):
    pairs = [(1, None), (2, ""), (3, " \t\n"), (None, "One two TWO\x00"), (5, "one two É é"), (5, "one two É é"), (9, "a " * 5000), (-4, "two")]
    check(scores(katz.score(docs(spark, pairs))), pairs)
    assert katz.score(empty).collect() == [] and set(COLUMNS) <= set(katz.score(empty).columns)
    none = katz.katz(docs(spark, pairs), F.lit(False)).collect()
    assert {r["score"] for r in none} == {0.0} and {r["train_tokens"] for r in none} == {0}


def test_katz_discounts():
    d = katz.discounts({1: 100, 2: 40, 3: 20, 4: 12, 5: 8, 6: 5})
    assert len(d) == 6 and all(0 < x < 1 for x in d[1:])
    # the mass taken from seen things is that of the things seen once
    counts = {1: 100, 2: 40, 3: 20, 4: 12, 5: 8}
    assert sum(n * r * (1 - d[r]) for r, n in counts.items()) == pytest.approx(100)
    assert len(katz.discounts({1: 5})) == 0 and len(katz.discounts({})) == 0
