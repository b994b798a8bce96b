"""Quality classifier: random-indexing word vectors and a two-layer network.

Every token (a word, a run of punctuation, a mark for a repeated word or an
all-capitals word) falls into one of ``BUCKETS`` hash buckets with a fixed sparse
ternary index vector.  A bucket's word vector is the sum, over its
occurrences in the *whole corpus*, of the index vectors of the two tokens on
either side: integer sums that are exact and do not depend on the order.
Each task sums its own share and the slabs of buckets are summed once more
after a shuffle, so what moves is at most ``BUCKETS`` rows a task.  The
finished table has ``BUCKETS`` x (``DIM`` + 1) numbers (a proven bound: 4 MB), and is broadcast.

A document is pooled to the weighted mean and deviation of its tokens'
vectors, frequent tokens weighing less, and its length.  A network with one hidden layer is
trained in numpy on a bounded, documented sample: the ``SAMPLE`` labelled rows with the
smallest hash of the id.  A fifth of them is held back to fit the
temperature that calibrates the probabilities.

Inputs of a score are the text alone.  Defined results: null and empty texts
are pooled to zeros and get a score too; ids with contradicting labels, null
labels and labels other than 0 and 1 teach nothing; without usable
labels every score is 0.5, with one class only it is that class's smoothed share;
repeated rows and equal texts score alike; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import column, shuffle_partitions, smaller, store

BUCKETS = 16384
DIM = 64
NONZERO = 4
SLAB = 64
WINDOW = 2
SMOOTH = 1e-3
SAMPLE = 20_000
HIDDEN = 32
EPOCHS = 40
DECAY = 1e-2
SEED = 20
TOKEN = re.compile(r"\w+|[^\w\s]+")
CACHE = 200_000
PIECE = 1 << 17  # tokens summed at a time


def index_entries() -> tuple[np.ndarray, np.ndarray]:
    """The fixed ternary vectors: the places of the NONZERO entries of each row, and their signs."""
    rng = np.random.Generator(np.random.PCG64(SEED))
    places = np.argsort(rng.random((BUCKETS, DIM)), axis=1)[:, :NONZERO]
    return places, rng.integers(0, 2, (BUCKETS, NONZERO), dtype=np.int8) * 2 - 1


def index_vectors() -> np.ndarray:
    """The same as a table."""
    places, signs = index_entries()
    out = np.zeros((BUCKETS, DIM), dtype=np.int8)
    np.put_along_axis(out, places, signs, axis=1)
    return out


def _bucket(token: str) -> int:
    return zlib.crc32(token.lower().encode("utf-8", "surrogatepass")) % BUCKETS


REPEAT, CAPITALS = _bucket("\x00repeat"), _bucket("\x00capitals")


class _Known(dict):
    """The bucket of each token, doubled, plus one for an all-capitals word."""

    def __missing__(self, token: str) -> int:
        self[token] = code = 2 * _bucket(token) + (len(token) > 1 and token.isupper())
        return code


_KNOWN = _Known()


def buckets(text: str | None) -> np.ndarray:
    """The bucket of every token of the whole text, marks included, in order."""
    tokens = TOKEN.findall(text or "")
    if len(_KNOWN) >= CACHE:
        _KNOWN.clear()
    codes = np.fromiter(map(_KNOWN.__getitem__, tokens), dtype=np.int32, count=len(tokens))
    capitals = (codes & 1).astype(bool)
    again = np.zeros(len(tokens), dtype=bool)
    again[1:] = np.fromiter(map(eq, tokens[1:], tokens), dtype=bool, count=max(0, len(tokens) - 1))
    if not capitals.any() and not again.any():
        return codes >> 1
    place = np.cumsum(1 + capitals + again) - again - capitals - 1
    out = np.empty(len(tokens) + int(capitals.sum() + again.sum()), dtype=np.int32)
    out[place] = codes >> 1
    out[place[capitals] + 1] = CAPITALS
    out[(place + capitals + 1)[again]] = REPEAT
    return out


# ----------------------------------------------------------- word vectors
def _sums(batches):
    places, signs = index_entries()
    steps = (2 * places + (signs < 0)).astype(np.int32)  # a place's cells for +1 and -1
    total = np.zeros((BUCKETS, DIM + 1), dtype=np.int64)

    def add(ids: np.ndarray, borrowed: list[range]) -> None:
        real = ids >= 0
        own = real.copy()
        for r in borrowed:
            own[r.start:r.stop] = False
        total[:, DIM] += np.bincount(ids[own], minlength=BUCKETS)
        cells = []
        for d in range(1, WINDOW + 1):
            for centre, other in ((slice(d, None), slice(None, -d)), (slice(None, -d), slice(d, None))):
                both = own[centre] & real[other]
                near = ids[other][both]
                cells.append(((2 * DIM * ids[centre][both])[:, None] + steps[near]).ravel())
        sums = np.bincount(np.concatenate(cells), minlength=2 * BUCKETS * DIM).reshape(BUCKETS, DIM, 2)
        total[:, :DIM] += sums[:, :, 0] - sums[:, :, 1]

    gap = np.full(WINDOW, -1, dtype=np.int32)  # windows do not cross documents
    for batch in smaller(batches):
        held, size, borrowed = [], 0, []  # borrowed: places of tokens that belong to another piece
        for text in batch.column(0).to_pylist():
            ids = buckets(text)
            for at in range(0, len(ids), PIECE):  # a long text goes in pieces, each with the tokens on either side
                low, end = max(0, at - WINDOW), min(at + PIECE, len(ids))
                high = min(end + WINDOW, len(ids))
                if low < at:
                    borrowed.append(range(size, size + at - low))
                if end < high:
                    borrowed.append(range(size + end - low, size + high - low))
                held += [ids[low:high], gap]
                size += high - low + WINDOW
                if size >= PIECE:
                    add(np.concatenate(held), borrowed)
                    held, size, borrowed = [], 0, []
        if held:
            add(np.concatenate(held), borrowed)
    for slab in range(BUCKETS // SLAB):
        part = total[slab * SLAB:(slab + 1) * SLAB]
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([slab], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["slab", "sums"])


def _merge(batches):
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for slab, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            part = np.frombuffer(sums, dtype=np.int64)
            totals[slab] = totals[slab] + part if slab in totals else part
    for slab, part in totals.items():
        yield pa.RecordBatch.from_arrays([pa.array([slab], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["slab", "sums"])


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """BUCKETS x DIM weighted unit vectors, from every row of ``docs``."""
    p = min(BUCKETS // SLAB, shuffle_partitions(docs.sparkSession))
    sums = docs.select(column(text_col).alias("text")).mapInArrow(_sums, "slab int, sums binary")
    merged = sums.repartition(p, "slab").mapInArrow(_merge, "slab int, sums binary")
    total = np.zeros((BUCKETS, DIM + 1))
    for row in merged.collect():  # BUCKETS / SLAB rows of fixed size
        total[row["slab"] * SLAB:(row["slab"] + 1) * SLAB] = np.frombuffer(row["sums"], dtype=np.int64).reshape(SLAB, DIM + 1)
    count = total[:, DIM]
    length = np.sqrt((total[:, :DIM] ** 2).sum(axis=1))
    unit = total[:, :DIM] / np.maximum(length, 1)[:, None]
    share = count / max(count.sum(), 1)
    weight = SMOOTH / (SMOOTH + share)
    return np.concatenate([unit * weight[:, None], weight[:, None]], axis=1).astype(np.float32)


FEATURES = 2 * DIM + 2


def pool(text: str | None, vectors: np.ndarray, squares: np.ndarray | None = None) -> np.ndarray:
    """Mean and deviation of the weighted word vectors, mean weight, and length of one document.

    ``squares``: those of ``vectors``, if the caller pools many texts.
    """
    ids = buckets(text)
    out = np.zeros(FEATURES, dtype=np.float32)
    if not len(ids):
        return out
    unique, counts = np.unique(ids, return_counts=True)
    counts, n = counts.astype(np.float64), len(ids)
    mean = counts @ vectors[unique] / n
    square = counts @ (vectors[unique, :DIM].astype(np.float64) ** 2 if squares is None else squares[unique]) / n
    out[:DIM], out[DIM] = mean[:DIM], mean[DIM]
    out[DIM + 1:2 * DIM + 1] = np.sqrt(np.maximum(square - mean[:DIM] ** 2, 0))
    out[-1] = np.log1p(n) / 10
    return out


def pooler(vectors: np.ndarray):
    """``pool`` with the table and its squares at hand in 64 bits (17 MB)."""
    wide = vectors.astype(np.float64)
    squares = wide[:, :DIM] ** 2
    return lambda text: pool(text, wide, squares)


# ---------------------------------------------------------------- network
@dataclass
class Network:
    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh(((x - self.shift) / self.scale) @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def constant(score: float) -> Network:
    z = np.zeros(FEATURES)
    return Network(z, z + 1, np.zeros((FEATURES, 1)), np.zeros(1), np.zeros(1), float(np.log(score / (1 - score))))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def train(x: np.ndarray, y: np.ndarray, held: np.ndarray, epochs: int = EPOCHS) -> Network:
    """Fit on the rows not ``held``, then the temperature on those that are."""
    if not len(y):
        return constant(0.5)
    if y.min() == y.max():
        return constant((y.sum() + 1) / (len(y) + 2))
    fit = ~held if 0 < held.sum() < len(held) and 0 < y[~held].mean() < 1 else np.full(len(y), True)
    a, t = x[fit].astype(np.float64), y[fit].astype(np.float64)
    shift, scale = a.mean(axis=0), a.std(axis=0) + 1e-3
    a = (a - shift) / scale
    rng = np.random.Generator(np.random.PCG64(SEED))
    theta = [rng.normal(0, 1 / np.sqrt(FEATURES), (FEATURES, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    m, v, step = [np.zeros_like(p) for p in theta], [np.zeros_like(p) for p in theta], 0
    for epoch in range(epochs):
        order = rng.permutation(len(t))
        rate = 3e-3 * (1 - epoch / epochs) + 1e-4
        for at in range(0, len(t), 128):
            rows = order[at:at + 128]
            w1, b1, w2, b2 = theta
            h = np.tanh(a[rows] @ w1 + b1)
            error = (1 / (1 + np.exp(-(h @ w2 + b2[0]))) - t[rows]) / len(rows)
            back = error[:, None] * w2[None, :] * (1 - h**2)
            grads = [a[rows].T @ back + DECAY * w1, back.sum(axis=0), h.T @ error + DECAY * w2, np.array([error.sum()])]
            step += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                theta[i] = theta[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    net = Network(shift, scale, theta[0], theta[1], theta[2], float(theta[3][0]))
    if held.any():
        logits, truth = net.logits(x[held].astype(np.float64)), y[held]
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 101))
        net.temperature = float(min(grid, key=lambda c: _loss(logits / c, truth)))
    return net


# ------------------------------------------------------------------ spark
def held_out(id_col) -> "F.Column":
    """Whether crc32 of the id as text leaves 1 modulo 3: such rows never teach."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def lessons(docs: DataFrame, labels: DataFrame, label_col: str, sample: int) -> DataFrame:
    """(doc_id, text, y): at most ``sample`` labelled rows to learn from."""
    y = column(label_col)
    clear = labels.select(F.col("doc_id").cast("long").alias("doc_id"), y.cast("int").alias("y")).where(
        F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    clear = clear.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z").drop("z")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    usable = store(clear.join(ids, "doc_id", "left_semi"), "quality-labels")
    # Sorting only what can be among the smallest hashes keeps every task's share in proportion to the sample.
    share = min(1.0, (1.2 * sample + 100) / max(usable.count(), 1))
    few = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) < F.lit(int(share * (1 << 31))))
    picked = store(few.orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)), "doc_id").limit(sample), "quality-sample")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(F.broadcast(picked), "doc_id")  # at most ``sample`` rows of 12 bytes


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE) -> tuple[np.ndarray, Network]:
    """(word vectors, network)."""
    vectors = word_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def pooled(batches):
        pooled_ = pooler(shared.value)
        for batch in smaller(batches):
            got = [pooled_(t).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.binary()), batch.column(2)], names=["doc_id", "x", "y"])

    taught = lessons(docs, labels, label_col, sample)
    # one row an id (an id's rows may repeat); bounded by ``sample`` rows of 520 bytes
    rows = taught.mapInArrow(pooled, "doc_id long, x binary, y int").groupBy("doc_id").agg(F.min("x").alias("x"), F.min("y").alias("y")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    x = np.frombuffer(b"".join(r["x"] for r in rows), dtype=np.float32).reshape(len(rows), FEATURES)
    y = np.array([r["y"] for r in rows], dtype=np.float64)
    held = np.array([zlib.crc32(b"calibrate %d" % r["doc_id"]) % 5 == 0 for r in rows], dtype=bool)
    return vectors, train(x, y, held)


def scored(docs: DataFrame, vectors: np.ndarray, net: Network, score_col: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score."""
    shared = docs.sparkSession.sparkContext.broadcast((vectors, net))
    at = docs.columns.index("text")

    def run(batches):
        table, model = shared.value
        pooled = pooler(table)
        for batch in smaller(batches):
            x = np.array([pooled(t) for t in batch.column(at).to_pylist()], dtype=np.float32).reshape(batch.num_rows, FEATURES)
            score = pa.array(model.scores(x.astype(np.float64)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, score], names=[*batch.schema.names, score_col])

    from pyspark.sql import types as T

    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])
    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    src = docs.select(column("doc_id").cast("long").alias("doc_id"), column("text").alias("text"))
    rows = scored(src, *learn(src, labels, label_col, sample))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
