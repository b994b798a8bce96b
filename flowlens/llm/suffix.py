"""Exact removal of repeated byte strings, by column-wise multi-document construction.

Every byte is removed that a string of ``LENGTH`` bytes covers which also
starts anywhere else in the collection, the same document included.

Inserting one symbol of every document a round into the collection's
Burrows-Wheeler transform takes as many rounds as the longest document has
bytes, each over all data: for whole web documents that never ends.  So the
collection is first cut into short, aligned strings, without losing a repeat:

1. *Anchors.*  A window (a string of LENGTH bytes) is represented by the
   smallest of its hashed SEED-byte substrings, the leftmost of equals.
   Equal windows choose the same place.  Consecutive windows that share
   an anchor form a run; its bytes are the run's context.
2. Anchors whose seed occurs once have no repeated window and go (an
   aggregate and a join).  Contexts that occur more than once are repeated whole (an
   aggregate again; copies are never paired).
3. The *distinct* contexts of a seed with several of them are the documents
   of the collection.  A window around a seed reaches at least HALF
   bytes beyond it to the left or to the right, so each context is
   entered twice, with the seed grown to either side; contexts that share
   such a core stand in one group.  Core and at most HALF bytes on
   either side are the columns.
4. ``repeated``, the column-wise construction: columns are spooled to an
   external file and read once each, from the last to the first.  A
   round puts one symbol of every string before its suffix: the new
   suffix order is the old one sorted stably by the inserted column (that
   column in suffix order is the transform), and each common prefix
   is one more than the smallest between two suffixes of the same symbol.
   As strings are aligned, a round needs the transform's last
   column only.  The core is one symbol.  A window is repeated if its suffix shares
   HALF + 1 symbols with a neighbour.

A group of more than ``GROUP`` contexts is never held by one task: its windows
are hashed (128 bits) and counted by an aggregate, with the same result.

Defined results: null text is empty; matches never cross documents; repeated rows
repeat each other, so their long enough texts are removed whole; rows without an
id are rows like others; texts shorter than LENGTH keep all; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import tempfile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import column, discard, shuffle_partitions, smaller, store

LENGTH = 400
SEED = 256
GROUP = 32768
BATCH = 16384
SEGMENT = 1 << 22
BASE = 0x9E3779B97F4A7C15 | 1
U64 = np.uint64


def _half(length: int, seed: int) -> int:
    if (length - seed) % 2 or length <= seed:
        raise ValueError("length and seed differ by an even number above 0")
    return (length - seed) // 2


class _Powers:
    """BASE**i and BASE**-i modulo 2**64, doubled on demand."""

    def __init__(self):
        self.up, self.down = np.ones(1, dtype=U64), np.ones(1, dtype=U64)

    def upto(self, n: int):
        while len(self.up) < n:
            m = len(self.up)
            self.up = np.concatenate([self.up, self.up * U64(pow(BASE, m, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * U64(pow(BASE, -m, 1 << 64))])
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def _window_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` consecutive keys."""
    n = len(keys) - width + 1
    pad = -len(keys) % width
    blocks = np.concatenate([keys, np.full(pad, np.iinfo(U64).max, dtype=U64)]).reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1:width - 1 + n])


def runs(data: bytes, length: int = LENGTH, seed: int = SEED):
    """(hash of seed, hash of context, first window, windows, offset of the anchor in the first window) arrays of all runs."""
    found = []
    whole = np.frombuffer(data, dtype=np.uint8)
    width = length - seed + 1
    for at in range(0, max(0, len(data) - length + 1), SEGMENT):
        part = whole[at:at + SEGMENT + length - 1]
        up, down = _POWERS.upto(len(part) + 1)
        sums = np.zeros(len(part) + 1, dtype=U64)
        np.cumsum((part.astype(U64) + U64(1)) * up[:len(part)], out=sums[1:])
        hashes = (sums[seed:] - sums[:-seed]) * down[:len(part) - seed + 1]
        mixed = hashes ^ (hashes >> U64(32))
        mixed *= U64(0xD6E8FEB86659FD93)
        keys = (mixed & U64(0xFFFFFFFFFF000000)) | np.arange(len(mixed), dtype=U64)
        places = (_window_min(keys, width) & U64(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
        count = np.diff(np.append(first, len(places)))
        anchor = places[first]
        offset = anchor - first
        view, digest = memoryview(data), xxhash.xxh3_64_intdigest
        context = np.fromiter(
            (digest(view[s:e], o) for s, e, o in zip((first + at).tolist(), (first + at + count + length - 1).tolist(), offset.tolist())),
            dtype=U64, count=len(first))
        found.append((mixed[anchor].view(np.int64), context.view(np.int64), first + at, count, offset))
    if not found:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(5))
    return tuple(np.concatenate(c) for c in zip(*found))


# ---------------------------------------------------- column construction
def _between(lcp: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(lcp[low + 1 .. high]) of each pair, low < high, by a table of doubled ranges."""
    span = high - low
    out = np.empty(len(span), dtype=lcp.dtype)
    table, size = lcp, 1
    todo = np.arange(len(span))
    while len(todo):
        here = (span[todo] < 2 * size)
        rows = todo[here]
        out[rows] = np.minimum(table[low[rows] + 1], table[high[rows] - size + 1])
        todo = todo[~here]
        if len(todo):
            table = np.minimum(table[:-size], table[size:])
            size *= 2
    return out


def _insert(order: np.ndarray, lcp: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order and common prefixes after ``symbols`` (negative: end of string, equal to nothing) stand before the suffixes."""
    column_ = symbols[order]  # the transform: the inserted symbols in suffix order
    by = np.argsort(column_, kind="stable")
    sorted_ = column_[by]
    new = np.zeros(len(lcp), dtype=lcp.dtype)
    same = np.flatnonzero((sorted_[1:] == sorted_[:-1]) & (sorted_[1:] >= 0)) + 1
    new[same] = _between(lcp, by[same - 1], by[same]) + 1
    return order[by], new


def repeated(groups: np.ndarray, left: list[bytes], right: list[bytes], half: int) -> np.ndarray:
    """m x (half + 1) booleans: whether the window with i bytes left of the core occurs in another string of its group.

    ``left`` ends and ``right`` starts at the core; both may be shorter than ``half``.
    """
    m = len(groups)
    out = np.zeros((m, half + 1), dtype=bool)
    rows = np.arange(m)
    n_left, n_right = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    with tempfile.TemporaryFile() as columns:  # one column after the other, in the order of the rounds
        matrix = np.full((m, half), -1, dtype=np.int16)
        text = np.frombuffer(b"".join(right), dtype=np.uint8)
        inside = np.arange(half)[None, :] < n_right[:, None]
        matrix[inside] = text
        columns.write(np.ascontiguousarray(matrix.T[::-1]).tobytes())
        matrix = np.full((m, half), -1, dtype=np.int16)
        text = np.frombuffer(b"".join(x[::-1] for x in left), dtype=np.uint8)
        matrix[np.arange(half)[None, :] < n_left[:, None]] = text
        columns.write(np.ascontiguousarray(matrix.T).tobytes())
        del matrix, text, inside
        columns.seek(0)
        order, lcp = rows.copy(), np.zeros(m, dtype=np.int32)
        for _ in range(half):
            order, lcp = _insert(order, lcp, np.frombuffer(columns.read(2 * m), dtype=np.int16))
        order, lcp = _insert(order, lcp, groups)
        for i in range(half + 1):
            if i:
                order, lcp = _insert(order, lcp, np.frombuffer(columns.read(2 * m), dtype=np.int16))
            shared = lcp >= half + 1
            shared[:-1] |= shared[1:]
            out[order, i] = shared
    return out


# ------------------------------------------------------------------ spark
RUNS = "did long, hash long, seed long, ctx long, start long, n int, off int"


def _anchors(length, seed):
    def run(batches):
        names = [c.split()[0] for c in RUNS.split(", ")]
        for batch in smaller(batches):
            held, size = [], 0
            for did, hash_, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                s, c, start, n, off = runs(text.encode("utf-8", "surrogatepass"), length, seed)
                if len(s):
                    held.append((np.full(len(s), did), np.full(len(s), hash_), s, c, start, n.astype(np.int32), off.astype(np.int32)))
                    size += len(s)
                if size > 1 << 16:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=names)
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=names)

    return run


CONTEXTS = "k1 long, k2 long, did long, hash long, start long, n int, off int, single boolean, side int, lft binary, rgt binary"


def _cut(length, seed):
    """Contexts as (core key, bytes left and right of the core), once with the core grown to either side."""
    half = _half(length, seed)

    def run(batches):
        names = [c.split()[0] for c in CONTEXTS.split(", ")]
        rows = []

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.bool_(), pa.int32(), pa.binary(), pa.binary()])], names=names)

        for batch in smaller(batches):
            for did, hash_, text, wanted in zip(*(batch.column(i).to_pylist() for i in range(4))):
                data = text.encode("utf-8", "surrogatepass")
                for w in wanted:
                    start, n, off = w["start"], w["n"], w["off"]
                    anchor, end = start + off, start + n - 1 + length
                    # side 0: core is the seed and HALF bytes after it; side 1: HALF bytes before and the seed
                    for side, a, b in ((0, anchor, anchor + seed + half), (1, anchor - half, anchor + seed)):
                        if a < start or b > end:
                            continue
                        key = xxhash.xxh3_128_digest(data[a:b], side)
                        rows.append((int.from_bytes(key[:8], "big", signed=True), int.from_bytes(key[8:], "big", signed=True), did, hash_,
                                     start, n, off, w["single"], side, data[max(start, a - half):a], data[b:min(end, b + half)]))
                    if len(rows) >= 8192:
                        yield flush()
                        rows.clear()
        if rows:
            yield flush()
            rows.clear()

    return run


FOUND = "kind int, did long, hash long, a long, b long, w1 long, w2 long"


def _match(length, seed, limit):
    """kind 0: bytes a to b are removed; kind 1: a window of an oversized group, by its hash."""
    half = _half(length, seed)

    def spans(part):
        k, did, hash_, start, n, off, single, side, left, right = part
        hit = repeated(k, left, right, half)
        out = []
        for row in np.flatnonzero(hit.any(axis=1) & single).tolist():
            # window i starts i bytes before the core, which starts at the anchor or HALF before it
            core = start[row] + off[row] - (half if side[row] else 0)
            i = np.flatnonzero(hit[row, :])
            for piece in np.split(i, np.flatnonzero(np.diff(i) > 1) + 1):
                out.append((0, did[row], hash_[row], core - int(piece[-1]), core - int(piece[0]) + length, 0, 0))
        return out

    def windows(g):
        for (k1, k2, did, hash_, start, n, off, single, side, left, right) in g:
            core = start + off - (half if side else 0)
            for i in range(len(left) + 1):
                if half - i <= len(right):
                    key = xxhash.xxh3_128_digest(k1.to_bytes(8, "big", signed=True) + k2.to_bytes(8, "big", signed=True)
                                                 + left[len(left) - i:] + b"|" + right[:half - i], i)
                    yield (1, did if single else None, hash_, core - i, core - i + length,
                           int.from_bytes(key[:8], "big", signed=True), int.from_bytes(key[8:], "big", signed=True))

    def batch_of(rows):
        names = [c.split()[0] for c in FOUND.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 0 else pa.int64()) for i, c in enumerate(zip(*rows))], names=names)

    def run(batches):
        ready, held, key, over = [], [], None, False  # whole groups, the group being read, whether that is oversized

        def work():
            rows = [r for g in ready for r in g]
            ids = np.repeat(np.arange(len(ready)), [len(g) for g in ready])
            cols = list(zip(*rows))
            done = spans((ids, *cols[2:7], np.array(cols[7], dtype=bool), *cols[8:]))
            ready.clear()
            return done

        def hashed(keep: int):
            """The windows of the oversized group's rows at hand, once there are more than ``keep``."""
            if over and len(held) > keep:
                for at in range(0, len(held), 1024):
                    yield batch_of(list(windows(held[at:at + 1024])))
                held.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:2] != key:
                    yield from hashed(0)
                    if len(held) > 1:
                        ready.append(held)
                    key, held, over = row[:2], [], False
                    if sum(map(len, ready)) >= BATCH and (done := work()):
                        yield batch_of(done)
                held.append(row)
                over = over or len(held) > limit
                yield from hashed(1024)
        yield from hashed(0)
        if len(held) > 1:
            ready.append(held)
        if ready and (done := work()):
            yield batch_of(done)

    return run


def _release(spark) -> None:
    """Let Spark's cleaner drop the shuffle files of frames that are gone."""
    gc.collect()
    spark._jvm.System.gc()


def removed_spans(docs: DataFrame, length: int = LENGTH, seed: int = SEED, group: int = GROUP) -> DataFrame:
    """(did, hash, a, b): byte spans to remove, overlapping ones included.  ``docs``: (did, hash, text)."""
    spark = docs.sparkSession
    p = shuffle_partitions(spark)
    anchors = store(docs.mapInArrow(_anchors(length, seed), RUNS), "suffix-anchors")
    # Stored, so that both sides of the join are plain exchanges, of which Spark can split a hot seed's.
    seeds = store(anchors.groupBy("seed").agg(F.count("*").alias("c"), (F.min("ctx") != F.max("ctx")).alias("several")).where("c > 1").drop("c"), "suffix-seeds")
    shared = store(anchors.join(seeds, "seed"), "suffix-shared")
    discard(anchors, seeds)
    _release(spark)
    place = F.min(F.struct("did", "hash", "start", "n", "off")).alias("at")
    contexts = store(shared.groupBy("seed", "ctx").agg(F.count("*").alias("c"), place, F.first("several").alias("several")), "suffix-contexts")
    whole = shared.join(contexts.where("c > 1").select("seed", "ctx"), ["seed", "ctx"], "left_semi").select(
        "did", "hash", F.col("start").alias("a"), (F.col("start") + F.col("n") - 1 + length).alias("b"))
    wanted = contexts.where("several").select("at.*", (F.col("c") == 1).alias("single")).groupBy("did", "hash").agg(
        F.collect_list(F.struct("start", "n", "off", "single")).alias("wanted"))  # of one text: bounded by its length
    cut = docs.join(wanted, ["did", "hash"]).select("did", "hash", "text", "wanted").mapInArrow(_cut(length, seed), CONTEXTS)
    found = store(cut.repartition(p, "k1", "k2").sortWithinPartitions("k1", "k2").mapInArrow(_match(length, seed, group), FOUND), "suffix-found")
    _release(spark)
    hashed = found.where("kind = 1")
    twice = hashed.groupBy("w1", "w2").agg(F.count("*").alias("c")).where("c > 1").select("w1", "w2")
    counted = hashed.where("did is not null").join(twice, ["w1", "w2"], "left_semi")
    return whole.unionByName(found.where("kind = 0").select("did", "hash", "a", "b")).unionByName(counted.select("did", "hash", "a", "b"))


def merge_spans(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"


def _keep(batches):
    for batch in smaller(batches):
        rows = []
        for doc_id, text, spans in zip(*(batch.column(i).to_pylist() for i in range(3))):
            data, at, kept = text.encode("utf-8", "surrogatepass"), 0, []
            merged = merge_spans((s["a"], s["b"]) for s in spans or ())
            for a, b in merged:
                kept.append(data[at:a])
                at = b
            left = b"".join([*kept, data[at:]])
            rows.append((doc_id, len(data), sum(b - a for a, b in merged), len(merged), hashlib.sha256(left).hexdigest(), left.decode("utf-8", "replace")))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)],
                                         names=[c.split()[0] for c in RESULT.split(", ")])


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, seed: int = SEED, group: int = GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept of every row.

    ``kept`` is the text that is left (a character of which a span's end took some bytes shows as U+FFFD; the hash is of the bytes).
    """
    src = docs.select(column(id_col).cast("long").alias("doc_id"), F.coalesce(column(text_col), F.lit("")).alias("text"))
    src = src.select("doc_id", F.coalesce("doc_id", F.lit(-(2**63))).alias("did"), F.xxhash64("text").alias("hash"), "text")
    gone = removed_spans(src.select("did", "hash", "text"), length, seed, group)
    per_text = gone.distinct().groupBy("did", "hash").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    return src.join(per_text, ["did", "hash"], "left").select("doc_id", "text", "spans").mapInArrow(_keep, RESULT)
