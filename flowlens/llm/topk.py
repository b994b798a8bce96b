"""Exact top-k inner products through an impact-ordered index.

Vectors become integers, floor(scale * x).  The index is built per block of
about ``BLOCK`` vectors (fewer if cores would be idle): every non-zero component is a posting (dimension,
slot, sign) in the segment of its quantised impact, one of ``LEVELS`` equal
ranges of magnitude.  Beside a segment the index keeps, for each vector, the
length of what is still unknown of it once that segment and all above are
processed (unprocessed components and quantisation errors).

A query processes the segments score-at-a-time, in descending quantised
impact, adding query component times impact to its accumulators.  By
Cauchy-Schwarz a score lies within (query length * unknown length) of its
accumulator.  A query stops only when that proves that all but a few
vectors of the block are outside its top k, looking after the shares of postings in ``LOOK`` (so segments
between two looks are added in one product, four at most); these possible members are
rescored exactly from the integer vectors.  The k best of all blocks are
merged by a window with a limit per group.

Queries are dealt in groups of about ``GROUP``, so one task holds one block
and one group, at any size of the table.

Defined results: vectors that are null, hold null or non-finite components,
or components of 2**31 and more after scaling, and rows without an id take
no part; rows that share an id are one vector (the smallest, if they
differ); vectors of different lengths are never compared; ties go to the
smaller id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import column, store

SCALE = 256
BLOCK = 16384
LEAST = 2048  # vectors of a block, if there are cores for more blocks
GROUP = 8192
BATCH = 256
LEVELS = 16
LOOK = (0.5, 0.75, 0.9)  # shares of the postings after which bounds are compared
FEW = 64


def integers(df: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id, v array<int>, dim): the usable vectors, one row per id."""
    v = F.transform(column(vector_col), lambda x: x.cast("double") * F.lit(float(scale)))
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    # no score is above the larger of the two vectors' squared lengths
    square = F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)
    scaled = F.transform(v, lambda x: F.floor(x))
    exact = F.when(square < 2.0**62, scaled).otherwise(F.raise_error(F.lit("a vector's scores may leave the range of a long")).cast("array<bigint>"))
    src = df.select(column(id_col).cast("long").alias("id"), F.when(finite, exact).alias("s"))
    src = src.where("id is not null and s is not null").select("id", F.transform("s", lambda x: x.cast("int")).alias("v"))
    return src.groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))


INDEX_SCHEMA = "dim int, block long, level int, impact double, slots binary, dims binary, signs binary, unknown binary, ids binary, vectors binary"


def build(pdf: pd.DataFrame) -> pd.DataFrame:
    """The segments of one block; ids and integer vectors ride on the top segment."""
    dim, block = int(pdf["dim"].iloc[0]), int(pdf["block"].iloc[0])
    pdf = pdf.sort_values("id")
    x = np.array(pdf["v"].tolist(), dtype=np.int64).reshape(len(pdf), dim)
    size = np.abs(x)
    width = max(1, -(-(int(size.max(initial=0)) + 1) // LEVELS))
    level = np.where(size > 0, size // width, -1)
    unknown = (size.astype(np.float64) ** 2).sum(axis=1)
    rows = []
    for n in range(LEVELS - 1, -1, -1):
        slots, dims = np.nonzero(level == n)
        impact = n * width + (width - 1) / 2 if n else width / 2
        was = size[slots, dims].astype(np.float64)
        np.add.at(unknown, slots, (was - impact) ** 2 - was**2)
        top = n == LEVELS - 1
        rows.append((dim, block, n, impact, slots.astype("<u2").tobytes() if len(pdf) <= 65536 else slots.astype("<u4").tobytes(),
                     dims.astype("<i4").tobytes(), (x[slots, dims] < 0).tobytes(),
                     (np.sqrt(np.maximum(unknown, 0)) * (1 + 1e-9) + 1e-6).tobytes(),
                     pdf["id"].to_numpy(np.int64).tobytes() if top else None, x.astype("<i4").tobytes() if top else None))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in INDEX_SCHEMA.split(", ")])


def between_looks(segments: list) -> list:
    """The segments in order, grouped by the looks that follow them, and what is unknown after each group."""
    posted, seen, looks = sum(len(s[0]) for s in segments), 0, list(LOOK)
    steps, group = [], []
    for n, (slots, dims, signs, unknown) in enumerate(segments):
        group.append((slots, dims, signs))
        seen += len(slots)
        if n == len(segments) - 1 or (looks and seen >= looks[0] * posted):
            looks = [x for x in looks if seen < x * posted]
            steps.append((group, unknown))
            group = []
    return steps


def search(index: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best vectors of one block for each query of one group: (query_id, vec_id, score)."""
    none = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="int64")})
    if index.empty or queries.empty:
        return none
    index = index.sort_values("level", ascending=False)
    dim, top = int(index["dim"].iloc[0]), index.iloc[0]
    ids = np.frombuffer(top["ids"], dtype=np.int64)
    vectors = np.frombuffer(top["vectors"], dtype="<i4").reshape(len(ids), dim).astype(np.int64)
    slot_type = "<u2" if len(ids) <= 65536 else "<u4"
    segments = []
    for s in index.itertuples(index=False):
        signs = np.where(np.frombuffer(s.signs, dtype=bool), -s.impact, s.impact)
        segments.append((np.frombuffer(s.slots, dtype=slot_type), np.frombuffer(s.dims, dtype="<i4"), signs, np.frombuffer(s.unknown)))
    steps = between_looks(segments)
    qids = queries["id"].to_numpy(np.int64)
    q_all = np.array(queries["v"].tolist(), dtype=np.int64).reshape(len(qids), dim)
    out = []
    for at in range(0, len(qids), BATCH):
        qid, q = qids[at:at + BATCH], q_all[at:at + BATCH]
        length = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
        q_float, acc = q.astype(np.float64), np.zeros((len(qid), len(ids)))
        active = np.arange(len(qid))
        for n, (group, unknown) in enumerate(steps):
            plane = np.zeros((dim, len(ids)))
            for slots, dims, signs in group:  # a vector's component is a posting of one segment only
                plane[dims, slots] = signs
            acc += q_float[active] @ plane
            last = n == len(steps) - 1
            slack = length[active, None] * unknown[None, :] + np.abs(acc) * 1e-12
            own = ids[None, :] == qid[active, None]
            low = np.where(own, -np.inf, acc - slack)
            bar = np.partition(low, max(0, len(ids) - k), axis=1)[:, max(0, len(ids) - k)] if len(ids) > k else np.full(len(active), -np.inf)
            possible = (acc + slack >= bar[:, None]) & ~own
            proven = np.full(len(active), True) if last else possible.sum(axis=1) <= FEW
            for i in np.flatnonzero(proven).tolist():
                members = np.flatnonzero(possible[i])
                score = vectors[members] @ q[active[i]]
                best = np.lexsort((ids[members], -score))[:k]
                out.append((np.full(len(best), qid[active[i]]), ids[members][best], score[best]))
            acc, active = acc[~proven], active[~proven]
            if not len(active):
                break
    if not out:
        return none
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), (np.concatenate(c) for c in zip(*out)))))


def top_k(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, every: int = 50,
          scale: int = SCALE, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other vectors for each vector whose id is divisible by ``every``."""
    vectors = store(integers(df, id_col, vector_col, scale), "topk-vectors")
    n = vectors.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    blocks, groups = max(1, -(-n // block), min(cores, -(-n // LEAST))), max(1, -(-n // (every * group)))
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    index = store(dealt.groupBy("dim", "block").applyInPandas(build, INDEX_SCHEMA), "topk-index")
    cells = index.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = vectors.where(F.pmod("id", F.lit(every)) == 0).select(
        "id", "v", "dim", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("grp"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    found = cells.groupBy("dim", "block", "grp").cogroup(asked.groupBy("dim", "block", "grp")).applyInPandas(
        lambda a, b: search(a, b, k), "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
