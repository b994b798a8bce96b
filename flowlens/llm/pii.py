r"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Seeds are the matches of fixed patterns for emails, IP addresses, cards and
phones.  Their positions come from ``split`` and ``regexp_extract_all`` of the
same pattern: the lengths of the pieces and of the matches add up to code
point offsets.  The patterns are the contract's with possessive loops and a
start only where a leftmost match can start, which changes no match but
keeps the scan linear.

Every seed, and every other token, group of numbers or address with a spelt-out at (with brackets, or with a spelt-out dot, too) that looks like an identifier, is an
occurrence with three lexical patterns: the two words before it, the
words on either side, and its own shape (letters as ``a``, digits as
``0``).  So a card right after a phone, whose digits the base patterns read as one
overlong number, is found by its shape, and a disguised address by its words.
An unseen card must pass Luhn.  These form a graph of patterns and instances.  In
each round a pattern's confidence for a kind is the share of its
instances' scores among all its instances; patterns with at
least ``SUPPORT`` instances' worth of support and ``CONFIDENCE`` are accepted, and score the instances they match (noisy or).  Instances
above ``ACCEPT`` whose shape suits the kind are found, wherever they stand.
Scores change between rounds, so an accepted instance supports further
patterns, also ones that no seed meets.  Scores only rise, and the rounds
end when none does any more.

The text is read once, into a thin stored table of seeds and other
occurrences; the rounds run on the graph alone, aggregated by pattern and by instance.
Joins on patterns are salted by the instance, as one shape may hold a large share of all.

Texts longer than ``PIECE`` code points are cut into pieces of about that length, at
blanks that no pattern can span, so the time for a text grows with its length even if it is full of
identifiers (a long stretch without such a blank stays one piece).  Words around an occurrence are
looked for up to ``REACH`` code points from it, over the pieces' edges.

Defined results: null text counts as empty (no spans); base spans of
different kinds may overlap, found ones never overlap a base one; repeated rows and copies
are judged alike; an empty table gives an empty result; ``redact`` keeps
all other columns, and merges overlapping spans.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions import bloom
from flowlens.llm.common import column, discard, free_name, store

# Kinds in order, and the patterns of their base matches.
KINDS = ("email", "ip", "card", "phone")
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

PLUS = r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,4}(?![0-9])"
GROUP = r"(?:\([0-9]{2,5}\)|[0-9]{2,5})"
GROUPS = rf"(?<![0-9A-Za-z+.-])(?:[0-9]{{4}}(?:[ -][0-9]{{4}}){{3}}|{GROUP}(?:[ .-]{GROUP}){{1,5}})(?![0-9])"
LABEL = r"[A-Za-z0-9-]++"
DOT = r" ?[\[(](?i:dot)[\])] ?| (?i:dot) "
SPELT = rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(](?i:at)[\])] ?{LABEL}(?:(?: ?\. ?|{DOT}){LABEL})++"
# The same without brackets; every part has a letter, so that no number is part of it.
NAMED = rf"(?=[0-9.-]*+[A-Za-z]){LABEL}(?:\.{LABEL})*+"
SAID = rf"(?<![^\s\"'(<\[])(?=[0-9._%+-]*+[A-Za-z])[A-Za-z0-9._%+-]++ (?i:at) {NAMED}(?:(?:{DOT}){NAMED})++"
TOKEN = r"(?<!\S)[^\s0-9@(\[]*+[0-9@(\[]\S*+"
SUPPORT = 5.0
CONFIDENCE = 0.9
ACCEPT = 0.9
STILL = 1e-6  # a smaller rise of a score is none
REACH = 48
SALTS = 16
PIECE = 4096
# After a blank other than a space, or a space between two words that are neither an at nor a dot and of which
# the first ends, or the second begins, with a letter (or a comma).
CUT = (r"(?<=[^\S ])|(?<=[A-Za-z,;] )(?<!(?i:at|dot) )(?![\[(.]|(?i:at|dot))"
       r"|(?<=[^\s\])}.] )(?<!(?i:at|dot) )(?=[A-Za-z])(?!(?i:at|dot))")


def cut_up(text: Column) -> Column:
    """array<string>: the text in pieces of at least ``PIECE`` code points (but the last); an empty text is one piece."""
    return F.when(F.length(text) <= PIECE, F.array(text)).otherwise(
        F.regexp_extract_all(text, F.lit(rf"(?s).{{{PIECE},}}?(?:{CUT}|\z)|.+"), F.lit(0)))


def located(text: Column, pattern: str, likely: Column) -> Column:
    """array<struct<start, end, value>> of all matches; ``likely``: a cheap condition that every text with a match meets."""
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("piece"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc, pair):
        begin = acc["at"] + F.length(pair["piece"])
        end = begin + F.length(pair["value"])
        return F.when(pair["value"].isNull(), acc).otherwise(F.struct(
            end.alias("at"),
            F.concat(acc["out"], F.array(F.struct(begin.alias("start"), end.alias("end"), pair["value"].alias("value")))).alias("out")))

    return F.when(likely, F.aggregate(pairs, start, step, lambda acc: acc["out"])).otherwise(empty)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def base_spans(text: Column) -> Column:
    """array<struct<kind, start, end, value>> (kind: its place in KINDS) in order of kind and start."""
    found = [
        located(text, EMAIL, F.contains(text, F.lit("@"))),
        F.filter(located(text, IP, text.rlike(r"[0-9]\.[0-9]++\.[0-9]")), lambda m: m["value"].rlike(rf"^{PART}(?:\.{PART}){{3}}$")),
        F.filter(located(text, CARD, text.rlike(r"[0-9](?:[ -]?[0-9]){15}")),
                 lambda m: F.length(digits(m["value"])).between(16, 19) & F.call_function("luhn_check", digits(m["value"]))),
        F.filter(located(text, PHONE, F.contains(text, F.lit("+"))), lambda m: F.length(digits(m["value"])).between(8, 15)),
    ]

    def named(k: int):
        return lambda m: F.struct(F.lit(k).alias("kind"), m["start"], m["end"], m["value"])

    return F.concat(*(F.transform(a, named(k)) for k, a in enumerate(found)))


def looks(value: Column, kind: Column) -> Column:
    """Whether a token may be an identifier of the kind at all."""
    n = F.length(digits(value))
    return (
        F.when(kind == 0, value.rlike(r"@|[\[(](?i:at)[\])]| (?i:at) "))
        .when(kind == 1, value.rlike(r"^[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}$"))  # dotted ones the base pattern decides
        .when(kind == 2, F.when(value.rlike("^[0-9 ._-]+$") & n.between(16, 19), F.call_function("luhn_check", digits(value))).otherwise(False))
        .otherwise(value.rlike(r"^[+0-9 ()./-]+$") & n.between(7, 15))
    )


def _apart(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others."""
    return F.filter(spans, lambda m: ~F.exists(others, lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))


def _plausible(spans: Column) -> Column:
    kinds = range(len(KINDS))
    return F.filter(spans, lambda m: (F.length(m["value"]) >= 6) & reduce(lambda a, b: a | b, (looks(m["value"], F.lit(k)) for k in kinds)))


def _unnamed(spans: Column) -> Column:
    return F.transform(spans, lambda m: F.struct(F.lit(None).cast("int").alias("kind"), m["start"], m["end"], m["value"]))


def with_other(src: DataFrame) -> DataFrame:
    """``other``: identifier-like spans that overlap no base one and not each other, array<struct<kind (null), start, end, value>>.

    Plus-led groups of numbers come first, then other groups of numbers and
    addresses with a spelt-out at, those without brackets last, then single tokens.
    """
    text, base = F.col("text"), F.col("base")
    src = src.withColumn("plus", _apart(_plausible(_unnamed(located(text, PLUS, F.contains(text, F.lit("+"))))), base))
    groups = located(text, GROUPS, text.rlike(r"[0-9]\)?[ .-]\(?[0-9]"))
    spelt = located(text, SPELT, text.rlike(r"[\[(](?i:at)[\])]"))
    src = src.withColumn("wide", F.concat("plus", _apart(_plausible(_unnamed(F.concat(groups, spelt))), F.concat(base, F.col("plus")))))
    said = located(text, SAID, text.rlike(r"[ \[(](?i:dot)[ \])]") & text.rlike(" (?i:at) "))
    src = src.withColumn("wide", F.concat("wide", _apart(_plausible(_unnamed(said)), F.concat(base, F.col("wide")))))
    # Seven digits with only signs between them, an @ or at in brackets, or two colons after a hexadecimal digit.
    likely = text.rlike(r"[0-9]{4}|[0-9][+()./_-]++[0-9]|@|[\[(](?i:at)[\])]|[0-9A-Fa-f]:[0-9A-Fa-f]{0,4}:")
    trimmed = F.transform(located(text, TOKEN, likely), lambda m: F.struct(
        m["start"], m["value"], F.regexp_extract(m["value"], r"^[^0-9A-Za-z+@]*", 0).alias("head"),
        F.regexp_extract(m["value"], r"^[^0-9A-Za-z+@]*(.*?)[^0-9A-Za-z]*$", 1).alias("core")))
    cut = F.transform(trimmed, lambda m: F.struct(
        F.lit(None).cast("int").alias("kind"), (m["start"] + F.length(m["head"])).alias("start"),
        (m["start"] + F.length(m["head"]) + F.length(m["core"])).alias("end"), m["core"].alias("value")))
    tokens = _apart(_plausible(cut), F.concat(base, F.col("wide")))
    return src.withColumn("other", F.concat("wide", tokens)).drop("plus", "wide")


def _around(near: Column, shift: Column, m: Column) -> list[Column]:
    """The lexical patterns of an occurrence.  ``near``: its piece with ``REACH`` code points on either side, ``shift`` of them before."""
    at, end = m["start"] + shift, m["end"] + shift
    begin = F.greatest(F.lit(0), at - REACH)
    left = F.lower(F.substr(near, begin + 1, at - begin))
    right = F.lower(F.substr(near, end + 1, F.lit(REACH)))
    two = F.regexp_extract(left, r"(?:\S++\s++){0,2}\S*+$", 0)
    one = F.regexp_extract(left, r"(?:\S++\s++)?\S*+$", 0)
    follow = F.regexp_extract(right, r"^\S*+(?:\s++\S++)?", 0)
    return [F.concat(F.lit("L "), F.regexp_replace(two, r"\s+", " ")),
            F.concat(F.lit("B "), F.regexp_replace(F.concat(one, F.lit(" _ "), follow), r"\s+", " ")),
            F.concat(F.lit("S "), F.regexp_replace(F.regexp_replace(F.lower(m["value"]), r"\p{L}+", "a"), "[0-9]", "0"))]


def occurrences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Stored thin rows, one for each piece of a text: row, doc_id, hash, piece (its number), offset, base, other (both with their lexical patterns)."""
    src = docs.select(column(id_col).cast("long").alias("doc_id"), F.coalesce(column(text_col), F.lit("")).alias("text"))
    src = src.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("hash"), cut_up(F.col("text")).alias("pieces"))
    ends = F.aggregate("pieces", F.array(F.lit(0)), lambda acc, p: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(p))))
    src = src.withColumn("offsets", ends)

    def part(p, i):
        before = F.when(i > 0, F.right(F.get("pieces", i - 1), F.lit(REACH))).otherwise(F.lit(""))
        after = F.coalesce(F.left(F.get("pieces", i + 1), F.lit(REACH)), F.lit(""))
        return F.struct(p.alias("text"), F.get("offsets", i).alias("offset"), before.alias("before"), after.alias("after"))

    src = src.select("row", "doc_id", "hash", F.posexplode(F.transform("pieces", part)).alias("piece", "p")).select(
        "row", "doc_id", "hash", "piece", "p.offset", "p.text",
        F.length("p.before").alias("shift"), F.concat("p.before", "p.text", "p.after").alias("near"))
    src = with_other(src.withColumn("base", base_spans(F.col("text"))))

    def with_patterns(name):
        return F.transform(name, lambda m: F.struct(
            m["kind"], (m["start"] + F.col("offset")).alias("start"), (m["end"] + F.col("offset")).alias("end"), m["value"],
            F.array(*_around(F.col("near"), F.col("shift"), m)).alias("patterns")))

    return store(src.select("row", "doc_id", "hash", "piece", "offset",
                            with_patterns("base").alias("base"), with_patterns("other").alias("other")), "pii-thin")


def discover(thin: DataFrame, rounds: int | None = None, support: float = SUPPORT, confidence: float = CONFIDENCE, accept: float = ACCEPT) -> DataFrame:
    """(value, kind): unseen instances that confident patterns match.  ``rounds``: at most so many; by default as many as change a score."""
    spans = thin.select(F.explode(F.concat("base", "other")).alias("m")).select("m.*")
    graph = spans.select(F.explode("patterns").alias("pattern"), F.lower("value").alias("value"), "kind").where("length(pattern) > 3")
    bit = F.coalesce(*(F.when(F.col("kind") == k, 1 << k) for k in range(len(KINDS))), F.lit(0))
    graph = graph.groupBy("pattern", "value").agg(F.bit_or(bit).alias("seen"))  # the kinds that it is a seed of
    edges = store(graph.withColumn("salt", F.pmod(F.xxhash64("value"), F.lit(SALTS))), "pii-edges")
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    # A pattern without enough instances can never be accepted; one without a seed can, by instances found before.
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= support)
    graph = store(edges.join(sizes.select("pattern", "n", salts), ["pattern", "salt"]), "pii-graph")
    discard(edges)
    kinds = F.array_compact(F.array(*(F.when(F.col("seen").bitwiseAND(1 << k) != 0, k) for k in range(len(KINDS)))))
    seeds = graph.where("seen > 0").select("value", F.explode(kinds).alias("k"), F.lit(1.0).alias("score")).distinct()
    found, done = seeds.limit(0), 0
    while rounds is None or done < rounds:
        scores = seeds.unionByName(found).groupBy("value", "k").agg(F.max("score").alias("score"))
        belief = (
            graph.join(scores, "value").groupBy("pattern", "k")
            .agg(F.sum("score").alias("mass"), F.max("n").alias("n"))
            .withColumn("conf", F.col("mass") / F.col("n"))
            .where((F.col("mass") >= support) & (F.col("conf") >= confidence))
        )
        reached = store(
            graph.where("seen = 0").join(belief.select("pattern", "k", "conf", salts), ["pattern", "salt"])
            .where(looks(F.col("value"), F.col("k")))
            .groupBy("value", "k").agg((1 - F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("conf")))))).alias("score")), "pii-found")
        before = found.withColumnRenamed("score", "was")
        risen = reached.join(before, ["value", "k"], "left").where(F.col("score") > F.coalesce("was", F.lit(0.0)) + STILL)
        found, done = reached, done + 1
        if risen.isEmpty():
            break
    best = found.where(F.col("score") >= accept).groupBy("value").agg(F.max(F.struct("score", (-F.col("k")).alias("k"))).alias("b"))
    return best.select("value", (-F.col("b.k")).alias("kind"))


def found_spans(thin: DataFrame, found: DataFrame, by: list[str]) -> DataFrame:
    """``by`` and found: array<struct<kind, start, end>> of the spans beyond the base ones."""
    rows = thin.select(*by, F.explode("other").alias("m")).select(*by, "m.start", "m.end", F.lower("m.value").alias("value"))
    return rows.join(found, "value").groupBy(*by).agg(F.collect_set(F.struct("kind", "start", "end")).alias("found"))


def _text_of(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", F.get(names, m["kind"]), m["start"].cast("string"), m["end"].cast("string"))), ",")


def extract(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (of base spans), spans (base and found) of every row."""
    thin = occurrences(docs, id_col, text_col)
    more = found_spans(thin, discover(thin, **limits), ["row"])
    spans = F.transform("base", lambda m: F.struct(m["kind"], m["start"], m["end"]))
    rows = thin.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.flatten(F.collect_list(spans))).alias("base")).join(more, "row", "left")
    plain = F.col("base")
    every = F.when(F.col("found").isNull(), plain).otherwise(F.array_sort(F.concat(plain, F.col("found"))))

    def of(k: int):
        return lambda m: m["kind"] == k

    counts = [F.size(F.filter("base", of(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(_text_of(plain), 256).alias("base_sha256"), _text_of(every).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """``docs`` with every span, base and found, replaced by ``[KIND]`` (overlapping spans by that of the first).

    Only texts that may have found spans, by a Bloom filter of the hashes of those that do, are shuffled to them.
    """
    thin = occurrences(docs, id_col, text_col)
    by = ["doc_id", "hash", "piece", "offset"]
    key, digest, extra, may = (free_name(docs, name) for name in ("pii_id", "pii_hash", "pii_found", "pii_may"))
    inside = F.transform("found", lambda m: F.struct((m["start"] - F.col("offset")).alias("start"), (m["end"] - F.col("offset")).alias("end"), m["kind"]))
    more = store(
        found_spans(thin, discover(thin, **limits), by)
        .groupBy(F.col("doc_id").alias(key), F.col("hash").alias(digest))
        .agg(F.map_from_entries(F.collect_list(F.struct("piece", inside))).alias(extra)), "pii-more")
    text = column(text_col)
    hashed = F.xxhash64(F.coalesce(text, F.lit("")))
    blocks = bloom.blocks_for(more.count())
    split = bloom.marked(docs, hashed, bloom.build(more, digest, blocks), blocks, may)
    joined = split.where(may).join(more, column(id_col).cast("long").eqNullSafe(F.col(key)) & (hashed == F.col(digest)), "left")
    joined = joined.drop(key, digest).unionByName(split.where(~F.col(may)).withColumn(extra, F.lit(None).cast(more.schema[extra].dataType)))
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    nothing = F.array().cast("array<struct<start:int,end:int,kind:int>>")
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def cleaned(piece, i):
        base = F.transform(base_spans(piece), lambda m: F.struct(m["start"], m["end"], m["kind"]))

        def step(acc, m):
            kept = F.substr(piece, acc["at"] + 1, m["start"] - acc["at"])
            fresh = F.struct(m["end"].alias("at"), F.concat(acc["out"], F.array(kept, F.get(names, m["kind"]))).alias("out"))
            merged = F.struct(F.greatest(acc["at"], m["end"]).alias("at"), acc["out"].alias("out"))
            return F.when((m["start"] >= acc["at"]) | (acc["at"] == 0), fresh).otherwise(merged)

        spans = F.array_sort(F.concat(base, F.coalesce(F.element_at(extra, i), nothing)))
        return F.aggregate(spans, begin, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substr(piece, acc["at"] + 1, F.length(piece))))

    clean = F.array_join(F.transform(cut_up(text), cleaned), "")
    return joined.withColumn(text_col, F.when(text.isNotNull(), clean)).select(*(column(c) for c in docs.columns))
