"""Document fingerprints from prefix polynomial hashes.

``Prefixes`` keeps, per text, the arrays H[m] = sum of c[i] * b**i over the
first m code points, modulo 2**31 - 1, for two bases.  Any span's hash is
(H[j] - H[i]) * b**-i, so two spans are compared in constant time, and
the longest common extension of two positions is found by binary search.

A fingerprint has the number of code points, the two hashes of the whole text,
and the ``KEEP`` smallest scrambled hashes of its distinct spans of ``SPAN`` code points
(the whole text if it is shorter).  Texts below ``SHORT`` code points have a second list, where
their shorter spans count too, of the widths in ``widths``, so that some span survives where half of a text does.
Equal texts have equal fingerprints.  The
likeness of two is the Dice share of common spans, estimated from the
smallest hashes of their union (exact up to ``KEEP`` spans): 1 for equal texts, about 1/2 if half is replaced (less for short texts, but above 0), 0 if no span is shared.
Two short texts are compared by their second lists, all others by the first, so like is compared with like.

``with_next`` deals the rows out by ranges of the id, so that each document meets
the next one: the cuts are quantiles of the id, and the first document
of every range also goes to the range before it (that of the first range
to the last).  Ranges are sorted by Spark and read as a stream; the text is shuffled
once, and no range is held in memory.

Defined results: null text counts as empty; rows without an id come first;
rows that share an id follow one another by text; a single row is its own
next one; two empty texts are alike (1); an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import column, shuffle_partitions, smaller

PRIME = (1 << 31) - 1
BASES = (1_103_515_245, 742_938_285)
SPAN = 16
SHORT = 64
KEEP = 64
NULL_ID = -(2**63)


def _mod(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME, for x below 2**62."""
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(31))
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(31))
    return np.where(x >= PRIME, x - np.uint64(PRIME), x)


class _Powers:
    """b**i and b**-i modulo PRIME, doubled on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, PRIME)
        self.up, self.down = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            m = len(self.up)
            self.up = np.concatenate([self.up, _mod(self.up * np.uint64(pow(self.base, m, PRIME)))])
            self.down = np.concatenate([self.down, _mod(self.down * np.uint64(pow(self.inverse, m, PRIME)))])
        return self.up[:n], self.down[:n]


_POWERS = [_Powers(b) for b in BASES]


class Prefixes:
    """Prefix hashes of one text."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
        self.n = len(codes)
        self.sums = []
        for p in _POWERS:
            up, _ = p.upto(self.n + 1)
            total = np.zeros(self.n + 1, dtype=np.uint64)
            np.cumsum(_mod(codes * up[:self.n]), out=total[1:])
            self.sums.append(_mod(total))

    def span(self, start: int, end: int) -> tuple[int, int]:
        """Hashes of the code points from ``start`` to ``end``, the same wherever they stand."""
        return tuple((int(s[end]) - int(s[start])) * pow(p.inverse, start, PRIME) % PRIME for s, p in zip(self.sums, _POWERS))

    def spans(self, width: int) -> np.ndarray:
        """Hashes (first base) of all spans of ``width`` code points."""
        s, n = self.sums[0], self.n - width + 1
        _, down = _POWERS[0].upto(self.n + 1)
        return _mod(_mod(s[width:] + np.uint64(PRIME) - s[:n]) * down[:n])


def common_extension(a: Prefixes, i: int, b: Prefixes, j: int) -> int:
    """Length of the longest common start of a[i:] and b[j:]."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a.span(i, i + mid) == b.span(j, j + mid) else (low, mid - 1)
    return low


def smallest(values: np.ndarray, keep: int) -> np.ndarray:
    """The ``keep`` smallest distinct values, ascending."""
    if len(values) > 4 * keep:
        low = np.unique(np.partition(values, 4 * keep)[:4 * keep])
        if len(low) >= keep:
            return low[:keep]
    return np.unique(values)[:keep]


def widths(n: int) -> list[int]:
    """The widths of the spans of a short text of ``n`` code points; one at least is no more than half of it."""
    return sorted({min(SPAN, n), min(4, n), *([1] if n < 8 else [])})


def _marks(p: Prefixes, of: list[int]) -> np.ndarray:
    if not p.n:
        return np.zeros(0, dtype=np.uint32)
    spans = np.concatenate([p.spans(w) for w in of])
    scrambled = (spans * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    return smallest(scrambled.astype(np.uint32), KEEP)


class Fingerprint:
    def __init__(self, text: str):
        p = Prefixes(text)
        self.prefixes = p
        self.marks = (_marks(p, [min(SPAN, p.n)]), *((_marks(p, widths(p.n)),) if p.n < SHORT else ()))
        whole = p.span(0, p.n)
        lists = "-".join(m.astype(">u4").tobytes().hex() for m in self.marks)
        self.text = f"{p.n:x}-{whole[0]:08x}{whole[1]:08x}-{lists}"


def parse(fingerprint: str) -> tuple[np.ndarray, ...]:
    """The lists of marks: of spans of one width and, for a short text, of several."""
    return tuple(np.frombuffer(bytes.fromhex(part), dtype=">u4").astype(np.uint32) for part in fingerprint.split("-")[2:])


def marks_likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return 0.0
    both = np.union1d(a, b)[:KEEP]
    shared = np.intersect1d(a, b, assume_unique=True)
    jaccard = int(np.count_nonzero(shared <= both[-1])) / len(both)
    return 2 * jaccard / (1 + jaccard)


def likeness(a: str, b: str) -> float:
    """Likeness (0 to 1) of two fingerprints."""
    return 1.0 if a == b else lists_likeness(parse(a), parse(b))


def lists_likeness(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> float:
    *_, (x, y) = zip(a, b)  # the last list that both have
    return marks_likeness(x, y)


def _like(a: Fingerprint, b: Fingerprint) -> float:
    return 1.0 if a.text == b.text else lists_likeness(a.marks, b.marks)


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by the start of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


# -------------------------------------------------------------- next rows
def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(b, tail, ord, doc_id, text), sorted within partitions by (b, tail, ord, text).

    Within one ``b`` each row's next document is the next row; rows with
    ``tail`` only serve as the next one of the row before.
    """
    spark = docs.sparkSession
    ranges = 4 * shuffle_partitions(spark)
    src = docs.select(
        F.coalesce(column(id_col).cast("long"), F.lit(NULL_ID)).alias("ord"), column(id_col).cast("long").alias("doc_id"),
        F.coalesce(column(text_col), F.lit("")).alias("text"))
    cuts = src.agg(F.percentile_approx("ord", [i / ranges for i in range(1, ranges)], 100 * ranges).alias("c")).first()["c"]
    cuts = sorted(set(cuts or [0]))
    numbered = src.withColumn("b", F.size(F.filter(F.lit(cuts), lambda c: c < F.col("ord"))))
    firsts = sorted((r["b"], r["f"]) for r in numbered.groupBy("b").agg(F.min("ord").alias("f")).collect())  # a row a range
    before = [(f, firsts[i - 1][0]) for i, (_, f) in enumerate(firsts)]
    prior = spark.createDataFrame(before, "ord long, prior int")
    places = F.when(F.col("prior").isNull(), F.array(F.struct("b", F.lit(False).alias("tail")))).otherwise(
        F.array(F.struct("b", F.lit(False).alias("tail")), F.struct(F.col("prior").alias("b"), F.lit(True).alias("tail"))))
    rows = numbered.join(F.broadcast(prior), "ord", "left").select(F.explode(places).alias("p"), "ord", "doc_id", "text")
    return (rows.select("p.b", "p.tail", "ord", "doc_id", "text")
            .repartition(shuffle_partitions(spark), "b").sortWithinPartitions("b", "tail", "ord", "text"))


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, common_start long")


def _compare(batches):
    before = None  # (range, id, text, fingerprint) of the row whose next one has not come yet
    rows = []
    for batch in smaller(batches):
        for b, tail, doc_id, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4))):
            if tail and (before is None or before[0] != b):
                continue
            own = Fingerprint(text)
            if before is not None and before[0] == b:
                _, was_id, was, print_ = before
                changed = edited(was, text)
                other = Fingerprint(changed)
                rows.append((was_id, len(was), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), print_.text,
                             other.text, _like(print_, other), _like(print_, own),
                             common_extension(print_.prefixes, 0, other.prefixes, 0)))
            before = None if tail else (b, doc_id, text, own)
            if len(rows) >= 1024:
                yield _batch(rows)
                rows = []
    if rows:
        yield _batch(rows)


def _batch(rows):
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64())
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and their likeness to it and to the next one."""
    return with_next(docs, id_col, text_col).mapInArrow(_compare, SCHEMA)
