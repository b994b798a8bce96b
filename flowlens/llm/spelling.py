"""Spelling variants: exact neighbours at one edit by a dictionary of trie-node pairs.

``vocabulary`` counts the words: maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` with A-Z lower-cased; where the crc32 of
``<doc_id>:<run>`` is divisible by ``every``, one code point is left out (a planted slip).  A task counts in a
bounded dictionary before the shuffle, so a frequent word is a row a dictionary.

``trie`` numbers the nodes of the trie of the sorted words: a word's path is the numbers of all its
prefixes.  The words are sorted by ranges; each range numbers its own nodes in one pass, and the nodes that
neighbouring ranges share (the common prefixes of the last word of one and the first of the next) take their
number from the first such border.  The same over the reversed words numbers the suffixes.

``pairs`` then gives every word w of length L its L + 1 *splits* (node of w[:i], node of w[i:]) and its L *skips* (node of
w[:i], node of w[i+1:]).  Words with a skip in common differ in that one code point.  A skip that equals a split of another word
means that this word lacks the code point.  Of equal neighbouring code points only the first may be skipped against a
split, so every pair of near words meets in exactly one key.  A key has one split at most and one skip for each
code point of the alphabet (90), so its list is bounded; no pair of words is ever a row.  Each key tells its members how many others
it has and the best of them.

``variants`` sums that up for each word, names its form (the near word of largest n, ties: smallest, if n is at least
twice the word's) and follows the forms to their root by doubling; n doubles at each step, so it takes few rounds.

Defined results: null and empty texts have no runs; a null id is written as nothing (``:<run>``); repeated rows count each;
a run may be as long as its text (work and memory in proportion); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import column, shuffle_partitions, smaller, store

RUN = re.compile("[a-zÀ-ÿ]+")
EVERY = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
HELD = 200_000
COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])


# ------------------------------------------------------------ vocabulary
def slipped(word: str, key: int, every: int = EVERY) -> str:
    """``word`` without one code point if ``key`` is divisible by ``every``."""
    if key % every:
        return word
    at = key % len(word)
    return word[:at] + word[at + 1:]


def _counter(every: int, least: int, held: int):
    def run(batches):
        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip((totals.keys(), totals.values()), COUNTS.types)], schema=COUNTS)

        totals: Counter = Counter()
        for batch in smaller(batches):
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lowered = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z only
                start = zlib.crc32(f"{'' if i is None else i}:".encode())
                for word, n in Counter(RUN.findall(lowered)).items():
                    key = zlib.crc32(word.encode(), start)
                    if key % every == 0:
                        word = slipped(word, key, every)
                    if len(word) >= least:
                        totals[word] += n
                if len(totals) >= held:
                    yield rows()
                    totals = Counter()
        if totals:
            yield rows()

    return run


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = EVERY, length: int = LEAST_LENGTH,
               count: int = LEAST_COUNT, held: int = HELD) -> DataFrame:
    """(word, n): words of at least ``length`` code points that occur ``count`` times or more in all of ``docs``."""
    src = docs.select(column(id_col).cast("long").alias("id"), column(text_col).alias("text"))
    counted = src.mapInArrow(_counter(every, length, held), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


# ------------------------------------------------------------------ tries
def common(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] == b[:low], a[:high] != b[:high]
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def borders(ends: list[tuple[int, str, str]]) -> dict[int, tuple]:
    """For each range (number, first word, last word; in order, none empty): its first and last word, the common prefix of each
    with the word across the border, and the numbers of the shared nodes there, by depth."""
    out, before = {}, []
    for at, (part, first, last) in enumerate(ends):
        left = before
        # a prefix that spans this border, too, keeps the number it got at the first border it spans
        shared = common(last, ends[at + 1][1]) if at + 1 < len(ends) else -1
        kept = min(common(first, last), len(left) - 1, shared)
        before = [left[d] if d <= kept else -1 - (at << 32 | d) for d in range(shared + 1)]
        out[part] = (first, last, left, before)
    return out


PATHS = "part int, at long, key string, payload long, path array<long>"
PATH_ROWS = pa.schema([("part", pa.int32()), ("at", pa.int64()), ("key", pa.string()), ("payload", pa.int64()), ("path", pa.list_(pa.int64()))])


def _walk(known: dict[int, tuple]):
    """The path of every key of each range, in a stream sorted by (part, key)."""

    def run(batches):
        part, last_key, path, made, at = None, "", [], 0, 0
        for batch in smaller(batches, 4096):
            out = []
            for p, key, payload in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if p != part:
                    part, last_key, path, made, at = p, "", [], 0, 0
                    first, last, left, right = known[p]
                keep = common(last_key, key) + 1 if path else 0
                del path[keep:]
                at_first, at_last = (min(common(key, w), len(b) - 1) if b else -1 for w, b in ((first, left), (last, right)))
                for d in range(keep, len(key) + 1):
                    if d <= at_first:
                        path.append(left[d])
                    elif d <= at_last:
                        path.append(right[d])
                    else:
                        path.append(p << 44 | made)
                        made += 1
                out.append((p, p << 44 | at, key, payload, list(path)))
                last_key, at = key, at + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), PATH_ROWS.types)], schema=PATH_ROWS)

    return run


def trie(keys: DataFrame, tag: str) -> DataFrame:
    """``keys`` (key, payload long; keys distinct) with the node numbers of all prefixes, and ``at``, which grows in the keys' order."""
    p = shuffle_partitions(keys.sparkSession)
    ranged = store(keys.repartitionByRange(p, "key").select(F.spark_partition_id().alias("part"), "key", "payload"), f"{tag}-ranges")
    # two words a range come to the driver
    ends = ranged.groupBy("part").agg(F.min("key"), F.max("key")).orderBy("part").collect()
    known = borders([tuple(r) for r in ends])
    return ranged.repartition(p, "part").sortWithinPartitions("part", "key").mapInArrow(_walk(known), PATHS)


# ------------------------------------------------------------------ pairs
def pairs(words: DataFrame) -> DataFrame:
    """(p, s, split, first, id, n): every split and skip of ``words`` (id, n, f, r, starts)."""
    f, r = F.col("f"), F.col("r")

    def pair(i, skip, first):
        return F.struct(F.get(f, i).alias("p"), F.get(r, i + skip).alias("s"), F.lit(skip == 0).alias("split"), first.alias("first"))

    length = F.size("f") - 1
    splits = F.transform(F.sequence(F.lit(0), length), lambda i: pair(i, 0, F.lit(False)))
    skips = F.transform(F.sequence(F.lit(0), length - 1), lambda i: pair(i, 1, F.get("starts", i)))
    return words.select("id", "n", F.explode(F.concat(splits, skips)).alias("x")).select("x.*", "id", "n")


def neighbours(words: DataFrame) -> DataFrame:
    """(id, n_near, best (n, -id)): the number of near words, and the one of largest n (ties: smallest)."""
    members = pairs(words).groupBy("p", "s").agg(F.collect_list(F.struct("split", "first", "id", "n")).alias("m")).where(F.size("m") > 1)
    rank = F.transform(F.filter("m", lambda x: ~x.split), lambda x: F.struct(x.n.alias("n"), (-x.id).alias("minus"), x.first.alias("first")))
    keys = members.select(F.sort_array(rank, False).alias("skips"), F.filter("m", lambda x: x.split).alias("whole"))
    whole = F.get("whole", F.lit(0))
    lone = F.struct(whole.n.alias("n"), (-whole.id).alias("minus"))

    def thin(x):
        return F.when(x.isNotNull(), F.struct(x.n.alias("n"), x.minus.alias("minus")))

    def told(x):
        other = thin(F.when(F.get("skips", F.lit(0)).minus == x.minus, F.get("skips", F.lit(1))).otherwise(F.get("skips", F.lit(0))))
        joined = x.first & whole.isNotNull()
        return F.struct((-x.minus).alias("id"), (F.size("skips") - 1 + joined.cast("int")).alias("near"),
                        F.greatest(other, F.when(joined, lone)).alias("best"))

    longer = F.filter("skips", lambda x: x.first)
    single = F.filter(F.array(F.struct(whole.id.alias("id"), F.size(longer).alias("near"), thin(F.get(longer, F.lit(0))).alias("best"))),
                      lambda x: x.id.isNotNull())
    rows = keys.select(F.explode(F.concat(F.transform("skips", told), single)).alias("x")).select("x.*").where("near > 0")
    return rows.groupBy("id").agg(F.sum("near").cast("long").alias("n_near"), F.max("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) of every word of ``forms`` (id, form): the last form of its chain, by doubling."""
    now = store(forms.select("id", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("id").alias("root"), F.col("root").alias("next"))
        if now.join(ahead, "root", "left_semi").isEmpty():
            return now
        now = store(now.join(ahead, "root", "left").select("id", F.coalesce("next", "root").alias("root")), "spelling-roots")


def group(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of each of ``words`` (word, n; distinct)."""
    forward = store(trie(words.select(F.col("word").alias("key"), F.col("n").alias("payload")), "spelling").select(
        F.col("at").alias("id"), F.col("key").alias("word"), F.col("payload").alias("n"), F.col("path").alias("f")), "spelling-forward")
    backward = trie(forward.select(F.reverse("word").alias("key"), F.col("id").alias("payload")), "spelling-back").select(
        F.col("payload").alias("id"), F.reverse("path").alias("r"))
    # whether a code point differs from the one before it
    chars = F.split("word", "(?!$)")
    starts = F.transform(chars, lambda c, i: (i == 0) | (c != F.get(chars, i - 1)))
    near = neighbours(forward.join(backward, "id").withColumn("starts", starts))
    known = store(forward.select("id", "word", "n").join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("best.n") >= 2 * F.col("n"), -F.col("best.minus")).alias("form"),
        F.when(F.col("best.n") >= 2 * F.col("n"), F.col("best.n")).alias("form_n")), "spelling-near")
    last = roots(known.where("form IS NOT NULL").select("id", "form"))
    name = known.select(F.col("id").alias("key"), F.col("word").alias("name"))
    linked = known.where("form IS NOT NULL").join(last, "id")
    linked = linked.join(name.select(F.col("key").alias("form"), F.col("name").alias("form_word")), "form")
    linked = linked.join(name.select(F.col("key").alias("root"), F.col("name").alias("root_word")), "root")
    alone = known.where("form IS NULL").select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n")
    return linked.select("word", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "n", "n_near", "form_n").unionByName(alone)


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs`` that is long and frequent enough."""
    return group(store(vocabulary(docs, id_col, text_col, **limits), "spelling-words"))


# crc32 of '<doc_id>:<run>' byte by byte, with the table of its 256 steps computed here.
CRC_STEPS = """
steps AS (
  SELECT list(list_reduce([1, 2, 3, 4, 5, 6, 7, 8],
    lambda a, i: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, b) ORDER BY b) AS t
  FROM (SELECT CAST(range AS BIGINT) AS b FROM range(256))
)"""


def crc_sql(blob: str) -> str:
    """DuckDB: the unsigned crc32 of the BLOB ``blob`` (of a row that ``steps`` is joined to)."""
    bytes_ = f"list_transform(range(octet_length({blob})), lambda i: CAST(('0x' || substr(hex({blob}), 2 * i + 1, 2)) AS BIGINT))"
    return (f"xor(4294967295, list_reduce({bytes_}, lambda a, x: xor(a // 256, t[1 + CAST(xor(a % 256, x) AS INTEGER)]), CAST(4294967295 AS BIGINT)))")


ORACLE = f"""
WITH RECURSIVE {CRC_STEPS.strip()},
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS k FROM runs GROUP BY ALL
), keyed AS (
  SELECT run, k, {crc_sql("encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)")} AS h FROM counted, steps
), slipped AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM keyed
), words AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3
), skips AS (
  SELECT word, n, i, substr(word, 1, i) AS a, substr(word, i + 2) AS b FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), links AS (
  SELECT x.word, y.word AS other, y.n AS m FROM skips x JOIN skips y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM skips x JOIN words y ON y.word = x.a || x.b
  UNION SELECT y.word, x.word, x.n FROM skips x JOIN words y ON y.word = x.a || x.b
), near AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-m, encode(other))) AS best, max(m) AS best_n FROM links GROUP BY word
), known AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * n THEN best END AS form, CASE WHEN best_n >= 2 * n THEN best_n END AS form_n
  FROM words w LEFT JOIN near USING (word)
), chain AS (
  SELECT word, word AS at FROM known
  UNION ALL SELECT c.word, k.form FROM chain c JOIN known k ON k.word = c.at WHERE k.form IS NOT NULL
), last AS (
  SELECT c.word, c.at AS root FROM chain c JOIN known k ON k.word = c.at WHERE k.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM known JOIN last USING (word)
"""
