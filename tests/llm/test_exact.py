"""Operators against brute force, on edge cases and on the small tables."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.llm import pieces, pii, prefixhash, simhash, suffix, topk, urlfilter, warc
from flowlens.llm import registry as R
from flowlens.llm.common import table
from tests.llm import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long, Score double, fp string, row int, block int"


def docs(spark, pairs):
    return spark.createDataFrame([(i, t, "en", f"s{n % 3}", len(t or ""), 0.5, "x", 1, 2) for n, (i, t) in enumerate(pairs)], DOCS)


def texts(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def word(rng):
    return "".join(rng.choice("abcdeàé") for _ in range(rng.randint(1, 7)))


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(5)
    prose = " ".join(word(rng) for _ in range(400))
    long = " ".join(word(rng) for _ in range(60_000))
    near = prose.split()
    near[200] = "CHANGED"
    return [
        (1, prose), (2, prose), (2, prose), (3, " ".join(near)), (4, None), (5, ""), (6, " \t\n "), (7, "one"), (8, "One TWO"),
        (9, long), (10, "y" * 1000), (11, "ab" * 700), (12, prose[100:900] + " tail"), (None, prose[300:1200]), (None, None),
        (13, "é" * 250), (14, "mail a@b.c, x@y.z@q.rr or +1 (523) 555-1055 and 4111 1111 1111 1111 from 10.0.0.255 not 10.0.0.256"),
        (15, "a@b.c_d@e.f 1.2.3.4.5.6.7.8 4111-1111-1111-1111-0000-11 5500005555555559 +12 +1234567890123456 ++49 30 1234567"),
        (16, "\x00\x01 nul \r\n\f\v ünï 漢字 😀 ＡＢ ﬁ"), (-7, "negative id"), (17, prose + long[:5000]),
    ]


@pytest.fixture(scope="module")
def empty(spark):
    return docs(spark, []).limit(0)


# ------------------------------------------------------------------ op 1
def vectors(spark, items):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in items], "vec_id long, embedding array<float>, label int, ID int")


def test_top_k_edges(spark):
    rng = np.random.default_rng(3)
    items = [(i, [float(x) for x in np.float32(rng.normal(0, 0.2, 8))]) for i in range(300)]
    items += [(400, items[50][1]), (401, items[50][1]), (150, items[150][1]), (500, None), (501, [None] * 8), (550, [float("nan")] * 8),
              (551, [float("inf")] * 8), (600, [0.0] * 8), (601, [0.0] * 8), (650, [0.5, 0.5]), (651, []), (None, [0.1] * 8)]
    want = brute.top_k({i: v for i, v in items if i is not None}.items())
    got = topk.top_k(vectors(spark, items), block=64, group=2)
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)
    assert topk.top_k(vectors(spark, []).limit(0)).count() == 0
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]


def test_top_k_large_values_stay_exact(spark):
    rng = np.random.default_rng(4)
    items = [(i, [float(x) for x in np.float32(rng.normal(0, 3000, 4))]) for i in range(120)]
    assert {tuple(r) for r in topk.top_k(vectors(spark, items)).collect()} == brute.top_k(items)


def test_top_k_refuses_scores_beyond_a_long(spark):
    items = [(i, [float(i), 1.0]) for i in range(20)]
    assert {tuple(r) for r in topk.top_k(vectors(spark, items + [(99, [2.0**22, -2.0**22])])).collect()} == brute.top_k(items + [(99, [2.0**22, -2.0**22])])
    for odd in ([2.0**23, 0.5], [1e30, 1.0]):
        with pytest.raises(Exception, match="range of a long"):
            topk.top_k(vectors(spark, items + [(99, odd)])).collect()


# ------------------------------------------------------------------ op 3
URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?q#f", "http://example.com", "http://example.com/en", "http://example.com/en/",
        "http://notexample.com/en/", "http://a.b.example.com/en/1", "http://x.www.example.com/en/", "http://net/es/", "http://a.net/fr/#x", "http://a.net/de/",
        "http://a.net?x=/es/", "http://com/", "http://com:80/", "http://.com/", "http://com./", "x://y://z.com/", "http://ÉX.com/é", "http://a.com/\n/en/"]


def judged(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut].translate(brute.LOWER), rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), h + p, a) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_url_filter_edges(spark, monkeypatch):
    pages = spark.createDataFrame([(n, u, "x", "y") for n, u in enumerate(URLS + URLS[4:6])], "page_id long, url string, html string, host string")
    want = Counter((n, *judged(u, urlfilter.RULES)) for n, u in enumerate(URLS + URLS[4:6]))
    assert rows(urlfilter.judge(pages)) == want
    monkeypatch.setattr(urlfilter, "MAX_BITS", 2)
    assert urlfilter.chunks_for(3, 20) > 3
    assert rows(urlfilter.judge(pages)) == want  # a chunk or less a key
    monkeypatch.setattr(urlfilter, "MAX_BITS", 1 << 24)
    assert urlfilter.judge(pages.limit(0)).count() == 0
    assert {r.verdict for r in urlfilter.judge(pages, rules=[]).collect()} == {"allow"}


@pytest.mark.parametrize("bits", [1 << 24, 900])
def test_url_cascade_is_exact_over_many_keys(spark, monkeypatch, bits):
    """In one chunk, and in several."""
    monkeypatch.setattr(urlfilter, "MAX_BITS", bits)
    rng = random.Random(2)
    hosts = [f"{word(rng)}{n}.{rng.choice(['com', 'net'])}" for n in range(4000)]
    rules = [(rng.choice(["allow", "block"]), h, rng.choice(["", "/", "/a/"])) for h in rng.sample(hosts, 700)]
    pages = [(n, f"http://{rng.choice(['', 'www.'])}{h}{rng.choice(['', '/', '/a/b', '/b'])}") for n, h in enumerate(hosts)]
    got = rows(urlfilter.judge(spark.createDataFrame(pages, "page_id long, url string"), rules))
    unique = {}
    for a, h, p in rules:
        unique[h, p] = "block" if "block" in (a, unique.get((h, p))) else a
    assert got == Counter((n, *judged(u, [(a, h.translate(brute.LOWER), p) for (h, p), a in unique.items()])) for n, u in pages)


# ------------------------------------------------------------------ op 4
def test_fingerprints_edges(spark, odd, empty):
    got = [r for r in prefixhash.fingerprints(docs(spark, odd)).collect()]
    want = brute.next_texts(odd)
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == Counter(
        (i, len(t), hashlib.sha256(prefixhash.edited(t, nxt).encode()).hexdigest()) for i, t, nxt in want)
    own = {t: prefixhash.Fingerprint(t).text for _, t, _ in want}
    assert len(set(own.values())) == len(own)
    near = Counter((i, own[t], round(prefixhash.likeness(own[t], own[nxt]), 9)) for i, t, nxt in want)
    assert Counter((r.doc_id, r.fingerprint, round(r.near_next, 9)) for r in got) == near
    for r in got:
        assert 0 <= r.near_edited <= 1 and abs(r.near_edited - prefixhash.likeness(r.fingerprint, r.edited_fingerprint)) < 1e-12
    assert prefixhash.fingerprints(empty).count() == 0
    (one,) = prefixhash.fingerprints(docs(spark, [(3, "abcd")])).collect()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0


def test_next_documents_across_ranges(spark, sf_dir):
    got = prefixhash.fingerprints(table(spark, sf_dir, "documents").repartition(7))
    want = brute.next_texts(texts(table(spark, sf_dir, "documents")))
    assert rows(got.select("doc_id", "edited_sha256")) == Counter(
        (i, hashlib.sha256(prefixhash.edited(t, nxt).encode()).hexdigest()) for i, t, nxt in want)


def test_prefix_hashes_answer_spans_and_extensions():
    rng = random.Random(1)
    a = "".join(rng.choice("ab") for _ in range(300))
    b = a[40:200] + "c" + a[:50]
    pa_, pb = prefixhash.Prefixes(a), prefixhash.Prefixes(b)
    for _ in range(500):
        i, j = rng.randrange(300), rng.randrange(len(b))
        n = rng.randint(0, min(300 - i, len(b) - j))
        assert (pa_.span(i, i + n) == pb.span(j, j + n)) == (a[i:i + n] == b[j:j + n])
        common = next((k for k in range(min(300 - i, len(b) - j)) if a[i + k] != b[j + k]), min(300 - i, len(b) - j))
        assert prefixhash.common_extension(pa_, i, pb, j) == common


def test_likeness_of_half_kept_short_texts():
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-+*/"
    for n in range(2, len(letters)):
        a = prefixhash.Fingerprint(letters[:n]).text
        assert prefixhash.likeness(a, prefixhash.Fingerprint(prefixhash.edited(letters[:n], "àéîõü" * 20)).text) > 0, n
        assert prefixhash.likeness(a, prefixhash.Fingerprint("漢字" * n).text) == 0


def true_likeness(a, b):
    """The Dice share of common spans, from their sets; as many spans as the larger side has in all."""
    def spans(t, widths):
        return {(w, t[i:i + w]) for w in widths for i in range(len(t) - w + 1)}

    short = len(a) < prefixhash.SHORT and len(b) < prefixhash.SHORT
    x, y = (spans(t, prefixhash.widths(len(t)) if short else [min(prefixhash.SPAN, len(t))]) for t in (a, b))
    return 2 * len(x & y) / (len(x) + len(y)) if x and y else float(a == b), len(x | y)


def test_likeness_against_the_true_share(spark):
    """Exact up to KEEP spans; beyond, the mean error is below 0.05 and none above five standard errors."""
    rng = random.Random(5)
    errors = []
    for n in [*range(0, 130), *(rng.randrange(130, 4000) for _ in range(120))]:
        a = "".join(rng.choice("abcdefgh é") for _ in range(n))
        cut = rng.randint(0, n)
        b = rng.choice([a[:cut] + "".join(rng.choice("abcdefgh") for _ in range(n - cut)), a[cut:], a + a[:cut], a[:cut] + "x" + a[cut:]])
        got, (want, spans) = prefixhash.likeness(prefixhash.Fingerprint(a).text, prefixhash.Fingerprint(b).text), true_likeness(a, b)
        if spans <= prefixhash.KEEP:
            assert abs(got - want) < 1e-9, (a, b)
        else:
            errors.append(abs(got - want))
    assert len(errors) > 150 and np.mean(errors) < 0.05 and max(errors) < 5 * 0.5 / math.sqrt(prefixhash.KEEP)


def test_likeness_does_not_jump_where_texts_cease_to_be_short():
    rng = random.Random(6)
    text = "".join(chr(rng.randrange(97, 123)) for _ in range(200))
    for n in range(40, 120):
        a, b = (prefixhash.Fingerprint(text[:m]) for m in (n, n + 1))
        assert prefixhash.likeness(a.text, b.text) == prefixhash._like(a, b) > 0.95, n


# ------------------------------------------------------------------ op 5
RESULT5 = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def small(odd):
    return [(i, t if t is None else t[:9000]) for i, t in odd]


def test_suffix_dedup_edges(spark, odd, empty):
    want = brute.suffix_dedup(small(odd))
    assert rows(suffix.dedup(docs(spark, small(odd))).select(RESULT5)) == want
    assert rows(suffix.dedup(docs(spark, small(odd)), group=2).select(RESULT5)) == want  # every group oversized
    assert suffix.dedup(empty).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_suffix_dedup_random(spark, seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abc ") for _ in range(rng.randint(20, 90))) for _ in range(12)]
    items = [(i, "".join(rng.choice(passages)[rng.randint(0, 6):] if rng.random() < 0.7 else "".join(rng.choice("abc ") for _ in range(rng.randint(1, 60)))
                         for _ in range(rng.randint(0, 9)))) for i in range(150)]
    got = suffix.dedup(docs(spark, items), length=60, seed=40)
    assert rows(got.select(RESULT5)) == brute.suffix_dedup(items, 60)
    assert rows(suffix.dedup(docs(spark, items), length=60, seed=40, group=3).select(RESULT5)) == brute.suffix_dedup(items, 60)


@pytest.mark.parametrize("size, gone", [(394, 0), (399, 0), (400, 400)])
def test_suffix_dedup_judges_passages_by_bytes_not_words(spark, size, gone):
    """A passage of over 50 words that three documents share goes from 400 bytes on, at 394 (the longest of ``benchmark``) it stays."""
    rng = random.Random(size)
    words = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 6))) for _ in range(120))
    passage = words[:size - 1] + "z"
    assert len(passage.split()) > 50
    other = ["".join(rng.choice("ijklmnop ") for _ in range(700)) for _ in range(6)]
    items = [(i, f"{other[2 * i]}{i}{passage}{i}{other[2 * i + 1]}") for i in range(3)]
    got = suffix.dedup(docs(spark, items))
    assert rows(got.select(RESULT5)) == brute.suffix_dedup(items)
    assert [(r.n_removed, r.n_spans) for r in got.collect()] == [(gone, int(gone > 0))] * 3


def test_suffix_dedup_small_table(spark, sf_dir):
    assert rows(R.op5_suffix_dedup(spark, sf_dir).select(RESULT5)) == brute.suffix_dedup(texts(table(spark, sf_dir, "documents")))


# ------------------------------------------------------------------ op 6
def pii_rows(df):
    return Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in df.collect())


def pii_want(pairs):
    out = []
    for i, t in pairs:
        spans = brute.base_spans(t)
        n = Counter(k for k, _, _ in spans)
        out.append((i, n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()))
    return Counter(out)


def test_pii_base_spans(spark, odd, empty, sf_dir):
    rng = random.Random(8)
    noise = [(100 + n, "".join(rng.choice("0123456789.@+- ()ab\n") for _ in range(rng.randint(0, 300)))) for n in range(400)]
    pairs = odd + noise
    assert pii_rows(pii.extract(docs(spark, pairs))) == pii_want(pairs)
    assert pii.extract(empty).count() == 0
    assert pii_rows(R.op6_pii(spark, sf_dir)) == pii_want(texts(table(spark, sf_dir, "documents")))


def test_pii_patterns_find_unseen_identifiers(spark):
    good = [(n, f"please write to user{n}@mail.example.org for details, doc {n}") for n in range(20)]
    new = [(50, "please write to hidden(at)example for details, doc x"), (51, "elsewhere hidden(at)example appears and 1234567890123 too")]
    noise = [(60 + n, f"the value {n}2345678901 is a count of things") for n in range(20)]
    spans = {r.doc_id: r.spans for r in pii.extract(docs(spark, good + new + noise)).collect()}
    assert spans[50] == "email:16:33" and spans[51] == "email:10:27"
    assert all(spans[i] == "" for i, _ in noise)
    clean = {r.doc_id: r.text for r in pii.redact(docs(spark, good + new + noise)).collect()}
    assert clean[3] == "please write to [EMAIL] for details, doc 3" and clean[51].startswith("elsewhere [EMAIL] appears")
    assert clean[60] == noise[0][1]


def test_pii_patterns_find_identifiers_of_several_words(spark):
    phones = [(n, f"do call me at +1 (523) 555-10{n:02d} by today, doc {n}") for n in range(20)]
    mails = [(30 + n, f"please write to user{n}@mail.example.org for details, doc {n}") for n in range(20)]
    valid = [c for c in (str(4000000000000000 + 7 * i) for i in range(900)) if brute.luhn(c)]
    four = [" ".join(c[i:i + 4] for i in range(0, 16, 4)) for c in valid[:24]]
    cards = [(60 + n, f"paid by card {x} on file, doc {n}") for n, x in enumerate(four[:20])]
    new = [(90, "do call me at (743) 555-3824 by today"), (91, "please write to jo [at] example [dot] org for details"),
           (92, "room (743) 555-3824 is not 12-34-5678"), (93, f"paid by card {four[20]} {four[21]} on file")]
    src = docs(spark, phones + mails + cards + new)
    spans = {r.doc_id: r.spans for r in pii.extract(src).collect()}
    assert spans[90] == "phone:14:28" and spans[91] == "email:16:41" and spans[92] == "phone:5:19"
    assert spans[93] == "card:13:32,card:33:52"
    clean = {r.doc_id: r.text for r in pii.redact(src).collect()}
    assert clean[91] == "please write to [EMAIL] for details" and clean[93] == "paid by card [CARD] [CARD] on file"


def test_pii_shapes_find_neighbours_that_the_base_patterns_drop(spark):
    valid = [c for c in (str(4000000000000000 + 7 * i) for i in range(600)) if brute.luhn(c)]
    cards, (a, b, c) = valid[:40], valid[40:43]
    seeds = [(100 + n, f"see {x} x +1 (20{n % 10}) 555-01{n:02d} y") for n, x in enumerate(cards)]
    both = [(50, f"so +1 (623) 555-0177 {a} end"), (51, f"so {b} {c} end"), (52, "no 1234567812345678 end")]
    spans = {r.doc_id: r.spans for r in pii.extract(docs(spark, seeds + both)).collect()}
    assert spans[50] == "card:21:37,phone:3:20" and spans[51] == "card:3:19,card:20:36" and spans[52] == ""


def _national(form, start, n):
    return [form.format(700 + (start + i) % 200, 1000 + start + i) for i in range(n)]


def test_pii_patterns_without_a_seed_find_the_next_ones(spark):
    seeds = [(n, f"do call me at +1 (523) 555-1{n:03d} by today, doc {n}") for n in range(200)]
    some = _national("({}) 555-{}", 0, 21)
    near = [(300 + n, f"do call me at {x} by today, doc {n}") for n, x in enumerate(some[:20])]
    # two hops: the shape of the 20 finds the 21st, which stands elsewhere
    spans = {r.doc_id: r.spans for r in pii.extract(docs(spark, seeds + near + [(400, f"room {some[20]} is free")])).collect()}
    assert all(spans[i] == "phone:14:28" for i, _ in near) and spans[400] == "phone:5:19"


def test_pii_rounds_go_on_while_there_is_news(spark):
    steps = [_national("({}) 555-{}", 0, 60), _national("{}-555-{}", 100, 6), _national("{} 555 {}", 200, 6), _national("{}.555.{}", 300, 7)]
    places = ["do call me at {} by today", "our desk has {} for guests", "the old list says {} in print", "a torn note shows {} in pencil"]
    items = [(n, places[0].format(f"+1 (523) 555-1{n:03d}")) for n in range(560)]
    # the first step stands among the seeds, each later one among the steps before it
    for n, place in enumerate(places):
        items += [(1000 * (n + 1) + i, place.format(x)) for i, x in enumerate(sum(steps[:n + 1], []))]
    spans = {r.doc_id: r.spans for r in pii.extract(docs(spark, items)).collect()}
    assert all(spans[i].startswith("phone:") for i, _ in items)


def test_pii_finds_identifiers_whatever_else_the_text_holds(spark):
    seeds = [(n, f"server at 10.0.0.{n} is up, row {n}") for n in range(60)] + [(60 + n, f"or dial +1 (523) 555-10{n:02d} now, row {n}") for n in range(60)]
    new = [(200, "server at fe80::abcd:ef is up"), (201, "server at fd00::a1:b2:c3 is up"), (202, "or dial 55....01....77....3 now")]
    spans = {r.doc_id: r.spans for r in pii.extract(docs(spark, seeds + new)).collect()}
    assert spans[200] == "ip:10:23" and spans[201] == "ip:10:24" and spans[202] == "phone:8:27"


def test_pii_finds_addresses_spelt_out_without_brackets(spark):
    mails = [(n, f"please write to user{n}@mail.example.org for details, doc {n}") for n in range(60)]
    phones = [(100 + n, f"call bob at +1 (523) 555-10{n:02d} dot, doc {n}") for n in range(60)]
    new = [(200, "please write to jo at example dot com for details"), (201, "please write to jo.b AT mail.example DOT co [dot] uk for details"),
           (202, "please write to jo (at) example dot com for details"), (203, "call bob at 743-555-3824 dot"), (204, "look at that dot on the map")]
    spans = {r.doc_id: r.spans for r in pii.extract(docs(spark, mails + phones + new)).collect()}
    assert [spans[i] for i in range(200, 205)] == ["email:16:37", "email:16:52", "email:16:39", "phone:12:24", ""]


def test_pii_pieces_change_nothing(spark, monkeypatch):
    rng = random.Random(31)
    words = ["jo", "example", "com", " at ", " dot ", "[at]", "(dot)", " AT", "data ", "12", "4000 0000", "+1 ", "(523)", "555-1234", "10.0.0.7", "a@b.co", ".", ",", " ", " ", " ", "\n", "\t", "-", "é", "x"]
    noise = [(1000 + n, "".join(rng.choice(words) for _ in range(rng.randint(0, 200)))) for n in range(400)]
    phones = [(n, f"do call me at +1 (523) 555-10{n:02d} by today, doc {n}") for n in range(20)]
    mails = [(30 + n, f"please write to user{n}@mail.example.org for details, doc {n}") for n in range(20)]
    new = [(90, "do call me at (743) 555-3824 by today " * 5), (91, "please write to jo [at] example [dot] org for details, " * 5),
           (92, "please write to jo at example dot com for details")]
    src = docs(spark, noise + phones + mails + new)
    whole, clean = rows(pii.extract(src)), rows(pii.redact(src))
    assert len([s for *_, s in whole.elements() if s.count("phone") == 5]) >= 1
    monkeypatch.setattr(pii, "PIECE", 20)
    assert max(r.n for r in src.select(F.size(pii.cut_up(F.col("text"))).alias("n")).collect()) > 10
    assert rows(pii.extract(src)) == whole and rows(pii.redact(src)) == clean


def test_pii_a_text_full_of_identifiers(spark):
    many = [(1, " ".join(f"user{n}@mail{n % 97}.example.org" for n in range(20000))), (2, None), (3, "")]
    assert pii_rows(pii.extract(docs(spark, many))) == pii_want([(i, t or "") for i, t in many])
    clean = {r.doc_id: r.text for r in pii.redact(docs(spark, many)).collect()}
    assert clean == {1: " ".join(["[EMAIL]"] * 20000), 2: None, 3: ""}


def test_redact_keeps_rows_and_columns(spark, odd):
    src = docs(spark, odd)
    out = pii.redact(src)
    assert out.columns == src.columns and out.count() == len(odd)
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[14].startswith("mail [EMAIL], [EMAIL]@q.rr or [PHONE] and [CARD] from [IP] not 10.0.0.256") and got[1] == odd[0][1]
    clash = pii.redact(src.withColumns({"pii_id": F.lit(7), "PII_FOUND": F.lit("x"), "piece": F.lit(1), "found": F.lit(2)}))
    assert clash.columns == [*src.columns, "pii_id", "PII_FOUND", "piece", "found"]
    assert {r.doc_id: r.text for r in clash.where("pii_id = 7 and PII_FOUND = 'x' and piece = 1 and found = 2").collect()} == got


# ------------------------------------------------------------------ op 7
def test_simhash_edges(spark, odd, empty, sf_dir):
    def run(df):
        return rows(simhash.near_duplicates(df).select("doc_id", simhash.hex64(F.col("fp")), "component_id"))

    assert run(docs(spark, odd)) == brute.near_duplicates(odd)
    assert simhash.near_duplicates(empty).count() == 0
    pairs = texts(table(spark, sf_dir, "documents"))
    assert rows(R.op7_simhash(spark, sf_dir)) == brute.near_duplicates(pairs)


def test_simhash_links_keep_every_component(spark):
    rng = random.Random(6)
    prints = set()
    for _ in range(40):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 30)):
            prints.add(x)
            for b in rng.sample(range(64), rng.randint(1, 3)):
                x ^= 1 << b
    prints = sorted(prints)
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if bin(prints[a] ^ prints[b]).count("1") <= 3:
                root[find(a)] = find(b)
    want = Counter(frozenset(prints[j] for j in range(len(prints)) if find(j) == r) for r in {find(i) for i in range(len(prints))})
    df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    for limit in (1024, 4):  # 4: every block's group is cut again
        found = {p: p for p in prints} | {r.node % 2**64: r.root % 2**64 for r in simhash.components(simhash.links(df, group=limit)).collect()}
        groups = {}
        for p in prints:
            groups.setdefault(found[p], set()).add(p)
        assert Counter(map(frozenset, groups.values())) == want


def test_simhash_no_task_gets_a_large_key(spark):
    rng = random.Random(9)
    prints = {rng.getrandbits(31) << 33 for _ in range(3000)}  # all agree in the low blocks
    df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    keys = simhash.block_keys(df, group=100).groupBy("c", "k").count().cache()
    assert keys.where("c < 64").agg(F.max("count")).first()[0] <= 100
    assert keys.where("c >= 64").count() > 0 and keys.agg(F.max("count")).first()[0] < 3000
    fed = simhash.links(df, group=100)._jdf.queryExecution().optimizedPlan().toString()
    assert fed.count("MapInArrow") == 1


# ------------------------------------------------------------------ op 8
PAGE = "page_id long, url string, html string, payload string, size int"


def test_warc_files_are_bounded_whatever_the_sizes(spark, tmp_path):
    """Tiny pages and large ones in one range."""
    import os

    pages = spark.range(0, 21_000, 1, 2).select(
        F.col("id").alias("page_id"), F.lit("http://x/").alias("url"),
        F.when(F.col("id") % 200 == 0, F.concat(F.repeat(F.lit("y"), 400_000), F.col("id").cast("string"))).otherwise(F.lit("tiny")).alias("html"))
    warc.write(pages, str(tmp_path / "a"))
    sizes = [os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(tmp_path / "a") for f in files if f.startswith("part-")]
    assert max(sizes) <= warc.FILE_BYTES and len(sizes) < 60
    records, gaps = warc.read(spark, str(tmp_path / "a"), payloads=False)
    assert records.count() == 21_000 and gaps.isEmpty()


def test_warc_edges(spark, tmp_path):
    big, fake = "é" * 600, "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 50
    items = [(1, "http://a/ b\n", big), (2, None, big), (3, "u", big[:-1]), (4, "u", None), (5, "u", ""), (6, "u", "x" * 999), (7, "u", "x" * 999),
             (8, "u", fake), (9, "u", fake), (9, "u", fake), (None, "u", fake), (None, "u", "y" * 2000), (10, "u", "\r\n\r\n" * 400)]
    pages = spark.createDataFrame([(i, u, h, "p", 1) for i, u, h in items], PAGE)
    warc.write(pages, str(tmp_path / "a"))
    records, gaps = warc.read(spark, str(tmp_path / "a"))
    want = brute.warc([(i, h) for i, _, h in items])
    assert rows(records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) == want
    assert gaps.count() == 0
    assert {bytes(r.payload).decode() for r in records.where("payload is not null").collect()} == {h or "" for _, _, h in items}
    warc.write(pages.limit(0), str(tmp_path / "b"))
    assert warc.read(spark, str(tmp_path / "b"))[0].count() == 0


def _records(n):
    out = []
    for i in range(n):
        payload = (f"page {i} " * 40).encode()
        block = warc.HTTP.encode() + payload
        out.append((f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nWARC-Payload-Digest: sha1:{hashlib.sha1(payload).hexdigest()}"
                    f"\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n")
    return out


@pytest.mark.parametrize("zipped", [False, True])
def test_salvage_recovers_later_records_and_logs_gaps(zipped):
    import gzip

    parts = [gzip.compress(r) if zipped else r for r in _records(6)]
    parts[1] = parts[1][:len(parts[1]) // 2]  # cut off
    parts[3] = parts[3][:40] + b"\x00\xff" + parts[3][42:]  # damaged
    data = b"".join(parts) + b"trailing rubbish"
    found = list(warc.salvage(data))
    assert [r[2][b"warc-record-id"] for r in found if r[0] == "record"] == [b"<urn:page:%d>" % i for i in (0, 2, 4, 5)]
    gaps = [(r[1], r[2]) for r in found if r[0] == "gap"]
    ends = np.cumsum([0, *map(len, parts)]).tolist()
    assert gaps == [(ends[1], ends[2]), (ends[3], ends[4]), (ends[6], len(data))]
    assert not [r for r in warc.salvage(b"")] and [r[0] for r in warc.salvage(b"junk")] == ["gap"]


def test_salvage_of_mixed_files():
    import gzip

    def ids(data):
        return [int(r[2][b"warc-record-id"][10:-1]) for r in warc.salvage(data) if r[0] == "record"]

    parts = _records(5)
    zipped = [gzip.compress(p) for p in parts]
    assert ids(b"\x00\x00" + zipped[0][2:] + b"".join(zipped[1:])) == [1, 2, 3, 4]  # the first member's mark is damaged
    assert ids(b"".join(parts[:2]) + b"".join(zipped[2:])) == [0, 1, 2, 3, 4]
    damaged = parts[2][:40] + b"??" + parts[2][42:]
    one = gzip.compress(b"".join([*parts[:2], damaged, *parts[3:]]))  # all records in one member
    found = list(warc.salvage(b"rubbish" + one))
    assert ids(b"rubbish" + one) == [0, 1, 3, 4]
    start = len(parts[0]) + len(parts[1])
    assert [r[1:3] for r in found if r[0] == "gap"] == [(0, 7), (7, 7 + len(one))]
    assert found[3][3].startswith(f"bytes {start} to {start + len(parts[2])} of the member: ")
    assert ids(gzip.compress(b"") + zipped[3]) == [3]
    inner = warc.HTTP.encode() + zipped[1]  # a gzip payload of a whole record is a payload, not a record
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:9>\r\nContent-Length: {len(inner)}\r\n\r\n"
    assert ids(head.encode() + inner + b"\r\n\r\n" + parts[4]) == [9, 4]


def test_salvage_keeps_records_before_a_members_damage():
    import gzip
    import zlib

    def found(data):
        got = list(warc.salvage(data))
        return [int(r[2][b"warc-record-id"][10:-1]) for r in got if r[0] == "record"], [r[1:] for r in got if r[0] == "gap"]

    rng, parts = random.Random(4), []
    for r in _records(400):  # over several pieces when zipped
        head, body = r[:-4].split(b"HTTP/1.1", 1)
        payload = rng.randbytes(900)
        block = warc.HTTP.encode() + payload
        head = head.split(b"WARC-Payload-Digest")[0] + f"WARC-Payload-Digest: sha1:{hashlib.sha1(payload).hexdigest()}\r\nContent-Length: {len(block)}\r\n\r\n".encode()
        parts.append(head + block + b"\r\n\r\n")
    for level in (9, 0):  # 0: records stand in the member as they are
        one, last = gzip.compress(b"".join(parts[:399]), level), gzip.compress(_records(400)[399])
        cut = one[:len(one) * 2 // 3]
        ids, gaps = found(cut)
        n = len(ids)
        assert ids == list(range(n)) and 255 < n < 275
        assert len(gaps) == 1 and gaps[0][1:] == (len(cut), "gzip member cut off") and len(cut) - gaps[0][0] < 1500
        ids, gaps = found(cut + last)
        assert ids == [*range(n), 399] and [b for _, b, _ in gaps] == [len(cut)]
        wrong = one[:-8] + bytes(4) + one[-4:]  # only the checksum
        ids, gaps = found(wrong + last)
        assert ids == [*range(400)] and [(b, r) for _, b, r in gaps] == [(len(wrong), "bad gzip member")]
    whole = zlib.compressobj(9, zlib.DEFLATED, 31)
    half = whole.compress(b"".join(parts[:100])) + whole.flush(zlib.Z_FULL_FLUSH)
    ids, gaps = found(half + b"\xff" * 50 + last)
    assert ids == [*range(100), 399] and [(b, r) for _, b, r in gaps] == [(len(half) + 50, "bad gzip member")]


# ------------------------------------------------------------------ op 9
def test_sentencepiece_edges(spark, odd, empty):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=R.model_path())
    extra = [(200, "  lead  and   trail  "), (201, "▁▁ ▁x▁"), (202, "THAT!! this*** " * 50), (203, " "), (204, "<s></s><unk><0x0A>")]
    pairs = odd + extra
    got = pieces.digests(docs(spark, pairs), R.model_path(), with_ids=True).collect()
    want = Counter()
    for i, t in pairs:
        ids = sp.encode(t or "", add_eos=True)
        want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert pieces.digests(empty, R.model_path()).count() == 0


def test_agenda_on_whole_runs_equals_words():
    v = pieces.Vocabulary(R.model_path())
    text = "▁the▁▁quick▁brøwn▁fox▁"
    assert v.merge(text) == [i for w in v.words.findall(text) for i in v.merge(w)]
