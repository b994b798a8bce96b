"""URL rules through Bloom filter cascades: exact membership without joins.

A rule is (action, host, path): it fits its host and all subdomains if the
url's path starts with the rule's path.  The rules have a few *shapes*
(number of host labels, length of path), so a url can only fit the keys
that these shapes cut from it: its last labels plus the start of its path.
All keys that the corpus yields are the key universe.

Per action, level 1 of a cascade is a Bloom filter of the listed keys,
level 2 one of the universe's keys that level 1 lets through wrongly,
level 3 one of the listed keys that level 2 lets through, and so on until
no false positive of the universe is left.  A key is listed if the first
level that refuses it is an even one, or if no level refuses it and their
number is odd; over the universe that is exact.  The filters are literals
in the plan: judging a url is a projection, without a join or Python.

Filters grow with the list, not with the corpus (the first level's rate is
set to listed / universe keys).  Where a level would exceed about ``MAX_BITS``, and so no longer be a
small literal, keys are dealt into chunks by hash. Each chunk has cascades of its own
over its part of the universe, and the urls' keys are judged chunk by chunk, in one pass over a thin stored table for each.

Defined results: host is lower-cased in A-Z only; a null url or one without
``://`` has an empty host and path, fits no rule and gets the default
verdict; of several rules the longest (host plus path) wins, of equal ones
the longer host; a rule listed as both is a block; repeated rows are judged
alike; empty tables or rule lists are fine; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import column, discard, store

MAX_BITS = 1 << 24  # 2 MB a level
LEVEL_RATE = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The rules of the registered query (action, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def split_url(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def shapes(rules) -> list[tuple[int, int]]:
    return sorted({(host.count(".") + 1, len(path)) for _, host, path in rules})


def keys(host: Column, path: Column, of: list[tuple[int, int]]) -> Column:
    """array<struct<n, h, key>>: the keys of the given shapes a url yields; n and h: length of key and host."""
    out, labels = [], F.split(host, "\\.", -1)
    for count, length in of:
        tail = F.array_join(F.slice(labels, F.size(labels) - count + 1, count), ".")
        fits = (host != "") & (F.size(labels) >= count) & (F.length(path) >= length)
        key = F.concat(tail, F.substring(path, 1, length))
        out.append(F.when(fits, F.struct(F.length(key).alias("n"), F.length(tail).alias("h"), key.alias("key"))))
    return F.array_compact(F.array(*out)) if out else F.array().cast("array<struct<n:int,h:int,key:string>>")


# ---------------------------------------------------------------- cascade
def _position(key: Column, level: int, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits))


class Level:
    """One Bloom filter: its number, bits, hashes and words (text of longs, folded to an array literal)."""

    def __init__(self, members: DataFrame, number: int, count: int, rate: float):
        self.number = number
        self.bits = 64 * max(1, math.ceil(-count * math.log(rate) / math.log(2) ** 2 / 64))
        self.hashes = max(1, round(self.bits / max(count, 1) * math.log(2)))
        self.hashes = min(self.hashes, 32)
        at = F.explode(F.array(*(_position(F.col("key"), number, i, self.bits) for i in range(self.hashes))))
        words = (
            members.select(at.alias("at"))
            .groupBy(F.expr("at div 64").alias("w"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))").alias("b"))
        )
        found = {int(r["w"]): int(r["b"]) for r in words.toLocalIterator()}  # about MAX_BITS / 64 rows at most
        self.words = ",".join(str(found.get(w, 0)) for w in range(self.bits // 64))

    def passes(self, key: Column) -> Column:
        words = F.split(F.lit(self.words), ",").cast("array<bigint>")
        test = F.lit(True)
        for i in range(self.hashes):
            at = _position(key, self.number, i, self.bits)
            test = test & (F.getbit(F.get(words, F.floor(at / 64).cast("int")), (at % 64).cast("int")) == 1)
        return test


class Cascade:
    def __init__(self, levels: list[Level]):
        self.levels = levels

    def holds(self, key: Column) -> Column:
        """Whether ``key`` is listed; exact for every key of the universe."""
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            out = F.when(level.passes(key), out).otherwise(F.lit(level.number % 2 == 0))
        return out


def first_rate(listed: int, others: int) -> float:
    return min(LEVEL_RATE, max(1e-9, listed / (math.sqrt(2) * max(others, 1))))


def chunks_for(listed: int, others: int) -> int:
    """How many chunks keep a first level (the largest one) at about MAX_BITS."""
    return max(1, math.ceil(-listed * math.log(first_rate(listed, others)) / math.log(2) ** 2 / MAX_BITS))


def _chunk(key: Column, chunks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(0)), F.lit(chunks))


def cascade(listed: DataFrame, universe: DataFrame, others: int) -> Cascade:
    """Of ``listed`` over ``universe``, both distinct ``key``; ``others``: about the number of the universe's."""
    n = listed.count()
    inside, outside, rate = listed, None, first_rate(n, others)
    levels: list[Level] = []
    written = []
    while n:
        levels.append(Level(inside, len(levels) + 1, n, rate))
        wrong = (universe if outside is None else outside).where(levels[-1].passes(F.col("key")))
        if outside is None:  # only here keys of the universe may be listed ones
            wrong = wrong.join(listed, "key", "left_anti")
        wrong = store(wrong.select("key"), "url-wrong")
        written.append(wrong)
        inside, outside, n, rate = wrong, inside, wrong.count(), LEVEL_RATE
    discard(*written)
    return Cascade(levels)


def _verdict(made: dict[str, Cascade], chunk: int, chunks: int):
    """What a key of the chunk is listed as: struct<n, h, key, verdict>, or null."""
    def of(k: Column) -> Column:
        def listed(action: str) -> Column:
            held = made[action].holds(k["key"])
            return held if chunks == 1 else (_chunk(k["key"], chunks) == chunk) & held

        def named(action: str) -> Column:
            return F.struct(k["n"], k["h"], k["key"], F.lit(action).alias("verdict"))

        return F.when(listed("block"), named("block")).when(listed("allow"), named("allow"))

    return of


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row."""
    rules = [(action, host.translate(str.maketrans(UPPER, LOWER)), path) for action, host, path in rules]
    if any(path and not path.startswith("/") for _, _, path in rules):
        raise ValueError("a rule's path is empty or starts with /")
    spark = pages.sparkSession
    host, path = split_url(column(url_col))
    cut = pages.select(column(id_col).alias("page_id"), host.alias("host"), path.alias("path")).withColumn(
        "keys", keys(F.col("host"), F.col("path"), shapes(rules)))
    universe = store(cut.select(F.explode("keys").alias("k")).select("k.key").distinct(), "url-keys")
    others = universe.count()
    blocked = {h + p for a, h, p in rules if a == "block"}
    lists = {"block": blocked, "allow": {h + p for a, h, p in rules if a != "block"} - blocked}
    frames = {a: store(spark.createDataFrame([(k,) for k in sorted(v)], "key string"), "url-listed") for a, v in lists.items()}
    chunks = max(chunks_for(len(v), others) for v in lists.values())
    rows, last = cut.withColumn("best", F.lit(None).cast("struct<n:int,h:int,key:string,verdict:string>")), None
    if chunks > 1:
        rows = last = store(rows, "url-cut")
    for c in range(chunks):
        mine = _chunk(F.col("key"), chunks) == c if chunks > 1 else F.lit(True)
        made = {a: cascade(f.where(mine), universe.where(mine), others // chunks) for a, f in frames.items()}
        found = F.array_compact(F.transform("keys", _verdict(made, c, chunks)))
        if chunks == 1:
            rows = rows.withColumn("best", F.array_max(found))
        else:
            rows = store(rows.withColumn("best", F.array_max(F.concat(F.array_compact(F.array("best")), found))), "url-cut")
            discard(last)
            last = rows
    discard(universe, *frames.values())
    return rows.select("page_id", "host", "path", F.col("best.key").alias("rule"),
                       F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"))


ORACLE = """
WITH r(action, host, path) AS (VALUES %s),
p AS (SELECT page_id, CASE WHEN coalesce(instr(url, '://'), 0) = 0 THEN '' ELSE substr(url, instr(url, '://') + 3) END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM p),
u AS (SELECT page_id, translate(raw, '%s', '%s') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h)
SELECT u.page_id, any_value(u.host) AS host, any_value(u.path) AS path,
       arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
       coalesce(arg_max(r.action, length(r.host || r.path)), 'allow') AS verdict
FROM u LEFT JOIN r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
GROUP BY u.page_id
""" % (", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in RULES), UPPER, LOWER)
