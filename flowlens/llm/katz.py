"""Language-model scores: a Katz backoff model of word pairs.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` of the text after A-Z are lower-cased, then one end.
The first context of a text is a start mark.  With r the count of a pair (v, w) in the training texts:

* pair seen:       P(w|v) = r* / D(v)
* pair unseen:     P(w|v) = a(v) P(w)
* context unseen:  P(w|v) = P(w)
* P(w) = r* / N for a word seen r times, and the mass that is left for a word never seen.

r* is Good-Turing's: r* = r d(r) for r up to K, r beyond it, with Katz's
d(r) = (((r + 1) n(r + 1) / (r n(r))) - A) / (1 - A), A = (K + 1) n(K + 1) / n(1); K is 5, or the largest
below it whose d(r) all lie between 0 and 1, and if there is none every count is discounted by a half.
D(v) is the context's count.  Where all words after v were seen more than K times, nothing is left for others, so D(v) is one more.
The backoff weight a(v) = (what is left after v) / (1 - the sum of P(w) over the words seen after v), both sums taken over
the whole table, so that P(.|v) over all known words and one unknown sums to one.

How it runs.  Documents are tokenised once into *blocks* of about ``BLOCK`` tokens (Parquet: the hashes of a block's
distinct words, and the text as numbers of them).  A block asks for each of its distinct words and pairs once:
its keys, sorted, are cut by their leading bits into *buckets*, whose number follows the corpus so that a bucket
holds about ``BLOCK`` keys.  A task holds one bucket: it sums the counts of all blocks, and answers each block.  One block of those
with a pair answers for it when a context's sums are made, in buckets again.  The tables of counts and of contexts' weights are
stored, partitioned by kind; what no later step reads is deleted.  All buckets take every key of their range from every block once, so a frequent word or pair is one
key a block like any other, and no task grows with it.

Words and pairs are known by 64-bit hashes (XXH64; among n different keys a collision has the chance n*n / 2**65).

Defined results: null text is empty (one token, the end); a null id teaches; repeated rows count and
are scored each; without training texts every score is 0 and every base score that of an empty table; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import column, discard, smaller, store

BLOCK = 1_500_000
K = 5
START, END = (np.uint64(xxhash.xxh64_intdigest(m)) for m in (b" start", b" end"))  # no word has a blank
WORDS, PAIRS = 1, 2


# ----------------------------------------------------------------- model
def discounts(counts: dict[int, int], most: int = K) -> np.ndarray:
    """d(r) for r = 0 to K (d(0) is not used), from n(r), the number of things seen r times; empty: every count loses a half."""
    n = [counts.get(r, 0) for r in range(most + 2)]
    for k in range(most, 0, -1):
        if min(n[1:k + 2]) == 0:
            continue
        a = (k + 1) * n[k + 1] / n[1]
        if a >= 1:
            continue
        d = [((r + 1) * n[r + 1] / (r * n[r]) - a) / (1 - a) for r in range(1, k + 1)]
        if all(0 < x < 1 for x in d):
            return np.array([1.0, *d])
    return np.zeros(0)


def discounted(r: np.ndarray, d: np.ndarray) -> np.ndarray:
    """r* of every count (0 stays 0)."""
    r = np.asarray(r, dtype=np.float64)
    if not len(d):
        return np.maximum(r - 0.5, 0.0)
    return r * np.where(r < len(d), d[np.minimum(r, len(d) - 1).astype(np.int64)], 1.0)


class Model:
    """The numbers that all blocks share: n(r) of words and pairs, tokens and distinct words."""

    def __init__(self, words: dict[int, int], pairs: dict[int, int], tokens: int, distinct: int):
        self.tokens, self.distinct = tokens, distinct
        self.word_d, self.pair_d = discounts(words), discounts(pairs)
        left = (distinct / 2 if not len(self.word_d)
                else sum(words.get(r, 0) * r * (1 - self.word_d[r]) for r in range(1, len(self.word_d))))
        self.unknown = left / tokens if tokens else 1.0

    def word(self, r: np.ndarray) -> np.ndarray:
        """P(w) by the word's count."""
        return np.where(r > 0, discounted(r, self.word_d) / max(self.tokens, 1), self.unknown)

    def base(self, r: np.ndarray) -> np.ndarray:
        return np.log10((r + 1.0) / (self.tokens + self.distinct + 1.0))

    def weights(self, count, left, seen):
        """(D, a) of contexts, by their count, what their pairs lost, and the sum of P(w) over the words seen after them."""
        full = left <= 0
        whole = np.where(full, count + 1.0, count)
        rest = np.where(full, 1.0, left) / np.maximum(whole, 1.0)
        return whole, rest / np.maximum(1.0 - seen, self.unknown)


# ---------------------------------------------------------------- blocks
class _Codes(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _packed(a: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(a).tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, kind, n: int) -> np.ndarray:
    size = n * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True), dtype=kind) if n else np.zeros(0, kind)


def _packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte by byte: the leading bytes of near keys vanish."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return _packed(steps.view(np.uint8).reshape(len(keys), 8).T)


def _unpacked_keys(data: bytes, n: int) -> np.ndarray:
    steps = np.ascontiguousarray(_unpacked(data, np.uint8, 8 * n).reshape(8, n).T)
    return np.cumsum(steps.view(np.uint64).ravel(), dtype=np.uint64)


BLOCKS = "ids array<long>, lengths array<int>, learns array<boolean>, size long, words binary, codes binary"
BLOCKS_ARROW = pa.schema([("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("learns", pa.list_(pa.bool_())),
                          ("size", pa.int64()), ("words", pa.binary()), ("codes", pa.binary())])


def _blocks(size: int):
    def run(batches):
        def fresh():
            return _Codes({b" start": 0, b" end": 1}), [], [], [], []

        def emit():
            hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in codes), dtype=np.uint64, count=len(codes))
            stream = np.concatenate(parts)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(
                (ids, lengths, learns, len(stream), hashes.tobytes(), _packed(stream)), BLOCKS_ARROW.types)], schema=BLOCKS_ARROW)

        codes, ids, lengths, learns, parts = fresh()
        held = 0
        for batch in smaller(batches):
            for i, text, learn in zip(*(batch.column(c).to_pylist() for c in range(3))):
                words = (text or "").encode("utf-8", "surrogatepass").lower().split()
                stream = np.empty(len(words) + 2, dtype=np.int32)
                stream[0], stream[-1] = 0, 1
                stream[1:-1] = np.fromiter(map(codes.__getitem__, words), dtype=np.int32, count=len(words))
                ids.append(i), lengths.append(len(stream)), learns.append(learn), parts.append(stream)
                held += len(stream)
                if held >= size:
                    yield emit()
                    codes, ids, lengths, learns, parts = fresh()
                    held = 0
        if ids:
            yield emit()

    return run


def blocks(docs: DataFrame, learns: Column, id_col: str = "doc_id", text_col: str = "text", size: int = BLOCK) -> DataFrame:
    """The documents as numbered words, about ``size`` tokens a row, stored under a block number."""
    src = docs.select(column(id_col).cast("long").alias("id"), column(text_col).alias("text"), F.coalesce(learns, F.lit(True)).alias("learns"))
    return store(src.mapInArrow(_blocks(size), BLOCKS).withColumn("block", F.monotonically_increasing_id()), "katz-blocks")


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The key of a pair, from those of its words."""
    x = a * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x = (x + b) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Block:
    """One block's tokens (all but start marks), their contexts, and its distinct words and pairs."""

    def __init__(self, row: dict):
        self.ids, self.lengths = row["ids"], np.array(row["lengths"], dtype=np.int64)
        self.learns = np.array(row["learns"], dtype=bool)
        stream = _unpacked(row["codes"], np.int32, row["size"])
        self.words = np.frombuffer(row["words"], dtype=np.uint64).copy()
        self.words[0], self.words[1] = START, END
        at = np.flatnonzero(stream != 0)
        self.token, self.context = stream[at], stream[at - 1]
        self.doc = np.repeat(np.arange(len(self.lengths)), self.lengths - 1)
        self.taught = self.learns[self.doc]

    def distinct(self, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sorted distinct keys, the place of every token's key among them (pairs) or of every word's (words), training counts)."""
        if order == WORDS:
            order_ = np.argsort(self.words)
            place = np.empty(len(order_), dtype=np.int64)
            place[order_] = np.arange(len(order_))
            counts = np.bincount(self.token[self.taught], minlength=len(self.words))
            counts[0] = self.learns.sum()
            return self.words[order_], place, counts[order_]
        keys = _mix(self.words[self.context], self.words[self.token])
        unique, place = np.unique(keys, return_inverse=True)
        return unique, place, np.bincount(place[self.taught], minlength=len(unique))


def _cuts(keys: np.ndarray, n: int) -> np.ndarray:
    """Where the sorted keys pass from one of ``n`` buckets to the next."""
    return np.searchsorted((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32), np.arange(n + 1, dtype=np.uint64))


def _rows(batches):
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


ASKED = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
ASKS = "kind int, bucket int, block long, n long, keys binary, counts binary"


def _asks(buckets: int):
    def run(batches):
        for row in _rows(batches):
            block = Block(row)
            for kind in (WORDS, PAIRS):
                keys, _, counts = block.distinct(kind)
                cuts, out = _cuts(keys, buckets), []
                for b in range(buckets):
                    low, high = int(cuts[b]), int(cuts[b + 1])
                    if low < high:
                        out.append((kind, b, row["block"], high - low, _packed_keys(keys[low:high]), _packed(counts[low:high].astype(np.uint32))))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), ASKED.types)], schema=ASKED)

    return run


# --------------------------------------------------------------- buckets
ANSWERS = "kind int, bucket int, block long, n long, counts binary, owns binary, stats array<long>"
ANSWERED = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("counts", pa.binary()),
                      ("owns", pa.binary()), ("stats", pa.list_(pa.int64()))])


def _answer(table: pa.Table) -> pa.Table:
    """One bucket: the counts of all blocks summed; for each block its keys' sums and which it answers for; n(r) on a row of its own."""
    table = table.sort_by("block")
    kind, bucket = table["kind"][0].as_py(), table["bucket"][0].as_py()
    sizes = table["n"].to_pylist()
    keys = np.concatenate([_unpacked_keys(k, n) for k, n in zip(table["keys"].to_pylist(), sizes)])
    counts = np.concatenate([_unpacked(c, np.uint32, n) for c, n in zip(table["counts"].to_pylist(), sizes)])
    unique, place = np.unique(keys, return_inverse=True)
    total = np.bincount(place, weights=counts, minlength=len(unique)).astype(np.int64)  # exact below 2**53
    owner = np.zeros(len(keys), dtype=bool)
    taught = np.flatnonzero(counts)
    _, first = np.unique(place[taught], return_index=True)
    owner[taught[first]] = True
    real = total[(unique != START) & (total > 0)] if kind == WORDS else total[total > 0]
    stats = [int(np.count_nonzero(real == r)) for r in range(1, K + 2)] + [len(real), int(real.sum())]
    each, ends = total[place], np.cumsum(sizes)
    out = [(kind, bucket, b, n, _packed(each[e - n:e]), _packed(np.packbits(owner[e - n:e])), None)
           for b, n, e in zip(table["block"].to_pylist(), sizes, ends.tolist())]
    out.append((kind, bucket, -1, 0, None, None, stats))
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), ANSWERED.types)], schema=ANSWERED)


def _told(rows: list[dict], kind: int) -> tuple[np.ndarray, np.ndarray]:
    """The answers of one kind to one block, in the order of its keys: (counts, owns)."""
    rows = sorted((r for r in rows if r["kind"] == kind), key=lambda r: r["bucket"])
    counts = [_unpacked(r["counts"], np.int64, r["n"]) for r in rows]
    owns = [np.unpackbits(_unpacked(r["owns"], np.uint8, -(-r["n"] // 8)), count=r["n"]).astype(bool) for r in rows]
    return np.concatenate(counts), np.concatenate(owns)


STATE = "kind string, bucket int, block long, n long, a binary, b binary, c binary, d binary, ids array<long>, lengths array<int>, learns array<boolean>"
STATED = pa.schema([("kind", pa.string()), ("bucket", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), *((x, pa.binary()) for x in "abcd"),
                    ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("learns", pa.list_(pa.bool_()))])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema) if rows else schema.empty_table()


def _block_state(model: Model, buckets: int):
    """What a block makes of the answers: each document's sums so far, its tokens that wait for a context's weight, and contexts' sums."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        block, told = Block(row), right.to_pylist()
        keys, place, _ = block.distinct(WORDS)
        count = _told(told, WORDS)[0][place]  # of every word of the block
        _, pair, _ = block.distinct(PAIRS)
        pairs, owns = _told(told, PAIRS)
        r, before, word = pairs[pair], count[block.context], np.log10(model.word(count))
        n = len(block.ids)
        known = np.bincount(block.doc, weights=count[block.token] > 0, minlength=n)
        base = np.bincount(block.doc, weights=model.base(count)[block.token], minlength=n)
        seen = r > 0
        with np.errstate(divide="ignore"):
            gain = np.where(seen, np.log10(discounted(r, model.pair_d)), word[block.token])
        # a pair that lost something shows that its context's count is whole; others wait
        sure = seen & (discounted(r, model.pair_d) < r)
        gain[sure] -= np.log10(before[sure])
        score = np.bincount(block.doc, weights=gain, minlength=n)
        waits = np.flatnonzero(~sure & (before > 0))

        first = np.full(len(pairs), -1)
        first[pair[::-1]] = np.arange(len(pair))[::-1]  # a token of each pair
        mine = first[owns]
        ctx, lost = block.context[mine], r[mine] - discounted(r[mine], model.pair_d)
        gone = np.bincount(ctx, weights=lost, minlength=len(count))
        after = np.bincount(ctx, weights=model.word(count[block.token[mine]]), minlength=len(count))
        wanted = np.zeros(len(count), dtype=bool)
        wanted[block.context[waits]] = True
        used = wanted.copy()
        used[ctx] = True
        codes = np.flatnonzero(used)
        codes = codes[np.argsort(place[codes])]  # by key
        where = np.full(len(count), -1)
        where[codes[wanted[codes]]] = np.arange(int(wanted.sum()))
        cuts, out = _cuts(block.words[codes], buckets), []
        for b in range(buckets):
            part = codes[int(cuts[b]):int(cuts[b + 1])]
            if len(part):
                out.append(("context", b, row["block"], len(part), _packed_keys(block.words[part]), _packed(gone[part]), after[part].tobytes(),
                            _packed(np.packbits(wanted[part])), None, None, None))
        waiting = np.stack([block.doc[waits], where[block.context[waits]], seen[waits]]).astype(np.int32)
        sums = np.stack([known, base, score])
        out.append(("sums", -1, row["block"], len(waits), sums.tobytes(), _packed(waiting),
                    before_count(count, codes, wanted).tobytes(), None, row["ids"], row["lengths"], row["learns"]))
        return _table(out, STATED)

    return run


def before_count(count: np.ndarray, codes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Counts of the contexts that wait, in the order of their keys."""
    return count[codes[wanted[codes]]].astype(np.int64)


WEIGHTS = "bucket int, block long, n long, gone binary, after binary"
WEIGHED = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("gone", pa.binary()), ("after", pa.binary())])


def _context_sums(table: pa.Table) -> pa.Table:
    """One bucket of contexts: sums over all blocks, given back to the blocks that wait for them."""
    table = table.sort_by("block")
    sizes = table["n"].to_pylist()
    keys = np.concatenate([_unpacked_keys(a, n) for a, n in zip(table["a"].to_pylist(), sizes)])
    gone = np.concatenate([_unpacked(b, np.float64, n) for b, n in zip(table["b"].to_pylist(), sizes)])
    after = np.concatenate([np.frombuffer(c, dtype=np.float64) for c in table["c"].to_pylist()])
    unique, place = np.unique(keys, return_inverse=True)
    gone, after = (np.bincount(place, weights=w, minlength=len(unique))[place] for w in (gone, after))
    out, at = [], 0
    for block, n, d in zip(table["block"].to_pylist(), sizes, table["d"].to_pylist()):
        want = np.unpackbits(_unpacked(d, np.uint8, -(-n // 8)), count=n).astype(bool)
        if want.any():
            out.append((table["bucket"][0].as_py(), block, int(want.sum()), gone[at:at + n][want].tobytes(), after[at:at + n][want].tobytes()))
        at += n
    return _table(out, WEIGHED)


SCORES = "doc_id long, learns boolean, n_tokens long, n_known long, base_score double, score double"
SCORED = pa.schema([("doc_id", pa.int64()), ("learns", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                    ("base_score", pa.float64()), ("score", pa.float64())])


def _finished(model: Model):
    """The scores of a block's documents: what waited is added."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row, told = left.to_pylist()[0], sorted(right.to_pylist(), key=lambda r: r["bucket"])
        n = len(row["ids"])
        known, base, score = np.frombuffer(row["a"], dtype=np.float64).reshape(3, n)
        if row["n"]:
            doc, at, seen = _unpacked(row["b"], np.int32, 3 * row["n"]).reshape(3, -1)
            gone, after = (np.concatenate([np.frombuffer(r[c], dtype=np.float64) for r in told]) for c in ("gone", "after"))
            whole, weight = model.weights(np.frombuffer(row["c"], dtype=np.int64), gone, after)
            more = np.where(seen == 1, -np.log10(whole)[at], np.log10(weight)[at])
            score = score + np.bincount(doc, weights=more, minlength=n)
        tokens = np.array(row["lengths"], dtype=np.int64) - 1
        cols = (row["ids"], row["learns"], tokens, known.astype(np.int64), base, score)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, SCORED.types)], schema=SCORED)

    return run


# ----------------------------------------------------------------- spark
def learnt(answers: DataFrame) -> Model:
    """The shared numbers, from the stored answers' rows of n(r): sums of 16 numbers come to the driver."""
    width = K + 3
    row = answers.where("block = -1").agg(*(
        F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("stats")[i])), F.lit(0)) for kind in (WORDS, PAIRS) for i in range(width))).first()
    words, pairs = ({r + 1: row[kind * width + r] for r in range(K + 1)} for kind in range(2))
    return Model(words, pairs, tokens=row[K + 2], distinct=row[K + 1])


def katz(docs: DataFrame, learns: Column, id_col: str = "doc_id", text_col: str = "text", size: int = BLOCK) -> DataFrame:
    """doc_id, learns, n_tokens, n_known, base_score, score, train_tokens of every row; ``learns`` marks the training texts."""
    spark = docs.sparkSession
    made = blocks(docs, learns, id_col, text_col, size)
    total = made.agg(F.sum("size")).first()[0]
    if total is None:
        return spark.createDataFrame([], SCORES + ", train_tokens long")
    buckets = max(1, -(-total // size))
    answers = store(made.mapInArrow(_asks(buckets), ASKS).groupBy("kind", "bucket").applyInArrow(_answer, ANSWERS), "katz-counts")
    model = learnt(answers)
    told = answers.where("block >= 0").drop("stats").groupBy("block")
    state = made.groupBy("block").cogroup(told).applyInArrow(_block_state(model, buckets), STATE)
    state = store(state, "katz-state", partition_by="kind")
    discard(made, answers)
    # the kind is a folder: only its own files are read
    contexts, sums = (state.where(F.col("kind") == kind).drop("kind") for kind in ("context", "sums"))
    weights = store(contexts.select("bucket", "block", "n", "a", "b", "c", "d").groupBy("bucket").applyInArrow(_context_sums, WEIGHTS), "katz-weights")
    discard(state, part="kind=context")
    sums = sums.select("block", "n", "a", "b", "c", "ids", "lengths", "learns")
    rows = sums.groupBy("block").cogroup(weights.groupBy("block")).applyInArrow(_finished(model), SCORES)
    return rows.withColumn("train_tokens", F.lit(model.tokens).cast("long"))


def held_out(id_col) -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 7: such texts never teach."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``."""
    rows = katz(docs, ~held_out(column("doc_id").cast("long")))
    return rows.select("doc_id", (~F.col("learns")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
