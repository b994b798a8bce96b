"""SimHash near-duplicates: fingerprints, pigeonhole blocks, components.

``fingerprints`` gives every document its 64-bit SimHash.  Words are
``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased, shingles are ``width``
words joined by one space (repeats count; fewer words: the whole sequence;
none: fingerprint zero), hashed by XXH64 of the UTF-8 bytes with seed 42.  A
bit is 1 if it is set in over half of the hashes.

``links`` finds all pairs of *distinct* fingerprints within three bits, up
to connectivity.  The 64 bits are cut into six blocks.  Two fingerprints
that differ in at most three bits agree in at least three blocks, so each
of the 20 choices of three blocks is a join key of about 32 bits, and pairs
of a key are verified by their Hamming distance.  A key's members are
linked to the smallest member of their local component (a star, never all
pairs).  A key with over ``GROUP`` members (counted by an aggregate before any
task holds them) is cut again: of the 32 bits it
leaves open, seven sub-blocks are made, and close pairs agree in four of
them; such a key leaves at most 15 bits open, so at most 2**15 distinct
fingerprints can share it.  That bound holds at every size, and for all that a task holds of a key.

``components`` joins the links by alternating large-star and small-star
steps, each written to the shared folder.

Defined results: null text counts as empty; rows with a null doc_id keep
their row, and get the smallest non-null doc_id of their component (null if
there is none); repeated rows share a fingerprint and so a component; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import column, discard, free_name, shuffle_partitions, smaller, store

SEED = 42
WIDTH = 3
MAX_BITS = 3
BLOCK_BITS = (11, 11, 11, 11, 10, 10)
SUB_BITS = (5, 5, 5, 5, 4, 4, 4)
GROUP = 1024
CHUNK = 65536


def fingerprint(text: str | None, width: int = WIDTH, seed: int = SEED) -> int:
    """The SimHash of one text as an unsigned integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not words:
        return 0
    if len(words) < width:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    digest = xxhash.xxh64_intdigest
    ones, total = np.zeros(64, dtype=np.int64), len(words) - width + 1
    for at in range(0, total, CHUNK):
        part = words[at:at + CHUNK + width - 1]
        n = len(part) - width + 1
        grams = zip(*(part[i:i + n] for i in range(width)))
        hashes = np.fromiter((digest(b" ".join(g), seed) for g in grams), dtype="<u8", count=n)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > total).tolist())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, key: Column | None = None) -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``; ``fp`` is the fingerprint as a signed long.  ``key``: a long to carry along."""

    def run(batches):
        for batch in smaller(batches):
            fps = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]],
                                             names=["doc_id", "fp", *batch.schema.names[2:]])

    more = [] if key is None else [key.alias("key")]
    src = docs.select(column(id_col).cast("long").alias("doc_id"), column(text_col).alias("text"), *more)
    return src.mapInArrow(run, "doc_id long, fp long" + (", key long" if more else ""))


# ------------------------------------------------------------------ links
def _ranges(bits, open_bits):
    """One mask per range: the next ``n`` of the positions ``open_bits`` for every n of ``bits``."""
    out, at = [], 0
    for n in bits:
        out.append(sum(1 << b for b in open_bits[at:at + n]))
        at += n
    return out


FULL = (1 << 64) - 1
MASKS = [sum(c) for c in combinations(_ranges(BLOCK_BITS, list(range(64))), 3)]


def sub_masks(mask: int) -> list[int]:
    """``mask`` with each choice of four of the seven sub-blocks it leaves open."""
    rest = [b for b in range(64) if not mask >> b & 1]
    sizes = list(SUB_BITS)
    sizes[0] += len(rest) - sum(sizes)
    return [mask | sum(c) for c in combinations(_ranges(sizes, rest), 4)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def stars(fps: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each member to the first member of its component, of distinct ``fps`` (uint64)."""
    n = len(fps)
    label = np.arange(n)
    step = max(1, 2_000_000 // max(n, 1))
    while True:
        new = label.copy()
        for at in range(0, n, step):
            near = np.bitwise_count(fps[at:at + step, None] ^ fps[None, :]) <= max_bits
            new[at:at + step] = np.where(near, new[None, :], n).min(axis=1)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(n))
    return fps[moved], fps[label[moved]]


def _groups(batches):
    """(table, key, members) of whole runs of equal (table, key) in a sorted stream."""
    rest = None
    for batch in batches:
        c, k, f = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        if rest is not None:
            c, k, f = np.concatenate([rest[0], c]), np.concatenate([rest[1], k]), np.concatenate([rest[2], f])
        if not len(c):
            continue
        last = np.flatnonzero((c != c[-1]) | (k != k[-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield c[:cut], k[:cut], f[:cut]
        rest = c[cut:], k[cut:], f[cut:]
    if rest is not None and len(rest[0]):
        yield rest


LINK_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _linker(batches):
    """The star edges of each key."""
    for c, k, f in _groups(batches):
        starts = np.flatnonzero(np.concatenate([[True], (c[1:] != c[:-1]) | (k[1:] != k[:-1])]))
        sizes = np.diff(np.append(starts, len(c)))
        two = starts[sizes == 2]
        x, y = f[two].view(np.uint64), f[two + 1].view(np.uint64)
        ok = np.bitwise_count(x ^ y) <= MAX_BITS
        left, right = [f[two + 1][ok]], [f[two][ok]]
        for at, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            a, b = stars(f[at:at + n].view(np.uint64))
            left.append(a.view(np.int64)), right.append(b.view(np.int64))
        out = [np.concatenate(v) for v in (left, right)]
        for at in range(0, len(out[0]), CHUNK):
            yield pa.RecordBatch.from_arrays([pa.array(v[at:at + CHUNK], pa.int64()) for v in out], schema=LINK_SCHEMA)


def block_keys(fps: DataFrame, group: int = GROUP) -> DataFrame:
    """(c, k, fp): table, key and member; keys over ``group`` members are replaced by their finer ones, of tables from 64 on."""
    spark = fps.sparkSession
    keys = F.explode(F.array(*(
        F.struct(F.lit(i).alias("c"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k")) for i, m in enumerate(MASKS))))
    rows = fps.select("fp", keys.alias("x")).select("x.c", "x.k", "fp")
    large = store(rows.groupBy("c", "k").agg(F.count("*").alias("n")).where(F.col("n") > group).select("c", "k"), "simhash-large")
    finer = spark.createDataFrame([(i, 64 * (i + 1) + j, _signed(m)) for i, mask in enumerate(MASKS) for j, m in enumerate(sub_masks(mask))],
                                  "c int, finer int, mask long")
    cut = rows.join(large, ["c", "k"], "left_semi").join(F.broadcast(finer), "c").select(
        F.col("finer").alias("c"), F.col("fp").bitwiseAND(F.col("mask")).alias("k"), "fp")
    return rows.join(large, ["c", "k"], "left_anti").unionByName(cut)


def links(fps: DataFrame, group: int = GROUP) -> DataFrame:
    """Edges (a, b) that connect exactly the distinct fingerprints ``fp`` within three bits of each other."""
    p = shuffle_partitions(fps.sparkSession)
    return block_keys(fps, group).repartition(p, "c", "k").sortWithinPartitions("c", "k", "fp").mapInArrow(_linker, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node of the component, for every node with an edge that is not its root."""
    e = store(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    while True:
        n, distinct = e.agg(F.count("*"), F.count_distinct("u")).first()
        if n == distinct and e.join(e.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))).distinct()
        new = store(small, "cc")
        discard(e)
        e = new


def _members(prints: DataFrame) -> DataFrame:
    """(fp, root) of every distinct fingerprint of ``prints``."""
    unique = prints.select("fp").distinct()
    roots = components(links(unique))
    return unique.join(roots, unique["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``."""
    prints = store(fingerprints(docs, id_col, text_col, width), "simhash-fp")
    named = _members(prints).join(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fp")
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    return prints.join(named.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id.

    Of different texts of that id in one component the smallest hash decides, of
    equal ones any row stays; a component without an id keeps a row, too.
    """
    own = column(id_col).cast("long")
    number = F.coalesce(own, F.lit(2**63 - 1))  # rows without an id come last
    key = F.xxhash64(F.coalesce(column(text_col), F.lit("")), own.isNull())
    prints = store(fingerprints(docs, id_col, text_col, width, key), "simhash-fp")
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("number"), "key"))
    a, b = free_name(docs, "simhash_number"), free_name(docs, "simhash_key")
    stay = (
        _members(prints).join(prints.groupBy("fp").agg(first.alias("first")), "fp")
        .groupBy("root").agg(F.min("first").alias("first"))
        .select(F.col("first.number").alias(a), F.col("first.key").alias(b))
    )
    # Decisions are made on thin keys: only the rows that go, or that are repeated, are looked up among whole ones.
    keys = prints.select(F.coalesce("doc_id", F.lit(2**63 - 1)).alias(a), F.col("key").alias(b)).groupBy(a, b).agg(F.count("*").alias("n"))
    told = store(keys.join(stay.withColumn("stays", F.lit(True)), [a, b], "left").where("stays is null or n > 1"), "simhash-told")
    discard(prints)
    rows = docs.withColumns({a: number, b: key})
    kept = rows.join(told.select(a, b), [a, b], "left_anti")
    repeated = told.where("stays").select(a, b)
    if not repeated.isEmpty():
        kept = kept.unionByName(rows.join(repeated, [a, b], "left_semi").dropDuplicates([a, b]))
    return kept.select(*(column(c) for c in docs.columns))


def hex64(col):
    return F.lower(F.lpad(F.hex(col), 16, "0"))
