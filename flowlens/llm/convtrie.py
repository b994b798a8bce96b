"""The prefix trie of conversations, by union-find over the common prefixes of sorted neighbours.

Conversations are brought to order and rebuilt (``rebuilt``): a conversation's turns are told apart by
a 128-bit digest of role and text, so a conversation is a string of 16 bytes a turn, and equal prefixes of turns are equal prefixes of bytes.
Strings are cut into *segments* of ``SEGMENT`` turns.  Segments are keyed by the trie they
belong to: the root's for the first ones, else that below the node where the turns before end (known by a sum of digests
over the segments before).  So no row and no group grows with the longest conversation.

``paths`` are the distinct segments of a trie, with their number of conversations, smallest member and bytes; copies
are one row.  They are sorted by ranges (trie, turns).  In a range every ``CHUNK`` paths are a *forest* (``forest``): the edges
between neighbours are taken in descending order of the prefix they share; each merge of two components makes the branching
node of that depth or extends it, and a component's chain below it is finished.  All values of a node are sums over
its range of sorted paths, so a merge only joins ranges:

* members, children and leaves count paths (a path is a leaf if the next one does not go on from it);
* ``saved`` = (bytes of all members from this node on) - (bytes that are new in each path against its neighbour).

The nodes on the first and the last path of a forest may go on in the next forest.  They are handed on as partial
rows (the contracted forest), corrected by the prefix shared across the border, and summed by node.  All other nodes are final.
Segments below a node add their totals to it: totals of tries are summed up over their descendants by doubling.

``ends_sha256`` needs the ids of all conversations that end at a node in ascending order: they are sorted by ranges, joined
to chunks of ``IDS`` ids, and the chunks of a node are hashed as a stream.

Defined results: rows without a conv_id take no part; null role or text is empty; turns that share a number stand in the order of
their digests; repeated rows are turns each; a conversation whose rebuilt form has no turn ends at the root; an empty table has no nodes; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import column, shuffle_partitions, store
from flowlens.llm.spelling import CRC_STEPS, crc_sql

WIDTH = 16  # bytes a turn
SEGMENT = 1024
CHUNK = 16_384
IDS = 16_384
GROUP, KEPT = 5, 9
ROOT = ""
NO_ENDS = hashlib.sha256(b"").hexdigest()


# --------------------------------------------------------------- ordering
PIECES = "part int, conv long, at long, n long, turns binary, sizes array<long>"
PIECE_ROWS = pa.schema([("part", pa.int32()), ("conv", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("turns", pa.binary()), ("sizes", pa.list_(pa.int64()))])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _pieces(size: int):
    """Runs of turns of one conversation in a sorted stream, at most ``size`` turns each; ``at``: turns before it in its part."""

    def run(batches):
        part = conv = None
        at, turns, sizes = 0, [], []
        for batch in batches:
            out = []
            for p, c, digest, n in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if c != conv or len(turns) == size:
                    if turns:
                        out.append((part, conv, at, len(turns), b"".join(turns), sizes))
                    at = at + len(turns) if c == conv else 0
                    part, conv, turns, sizes = p, c, [], []
                turns.append(digest), sizes.append(n)
            if out:
                yield _table(out, PIECE_ROWS)
        if turns:
            yield _table([(part, conv, at, len(turns), b"".join(turns), sizes)], PIECE_ROWS)

    return run


def ordered(table: DataFrame, names=("conv_id", "turn", "role", "text"), segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """(pieces of conversations: conv, at, n, turns, sizes; conversations: conv, len).

    One sort by ranges of thin rows, so a conversation of any length is spread over parts; the turns that
    one has in earlier parts (a row a part at most) are added to ``at``.
    """
    conv, turn, role, text = (column(n) for n in names)
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH))
    thin = table.where(conv.isNotNull()).select(conv.cast("long").alias("conv"), turn.alias("turn"), digest.alias("digest"),
                                                F.octet_length(text).cast("long").alias("size"), F.monotonically_increasing_id().alias("tie"))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("tie")]
    laid = thin.repartitionByRange(shuffle_partitions(table.sparkSession), *order).sortWithinPartitions(*order)
    laid = laid.select(F.spark_partition_id().alias("part"), "conv", "digest", "size")
    pieces = store(laid.mapInArrow(_pieces(segment), PIECES), "trie-pieces")
    runs = pieces.groupBy("part", "conv").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    carried = runs.withColumn("before", before).where("before > 0").select("part", "conv", "before")  # a row a part at most
    placed = pieces.join(F.broadcast(carried), ["part", "conv"], "left").select(
        "conv", (F.col("at") + F.coalesce("before", F.lit(0))).alias("at"), "n", "turns", "sizes")
    return store(placed, "trie-placed"), store(runs.groupBy("conv").agg(F.sum("n").alias("len")), "trie-convs")


def _cut(turns: Column, start: Column, n: Column) -> Column:
    return F.substring(turns, (start * WIDTH + 1).cast("int"), (n * WIDTH).cast("int"))


def _joined(at: str) -> list[Column]:
    """Pieces of a group put together in the order of ``at``; what a group holds is bounded by the caller."""
    parts = F.sort_array(F.collect_list(F.struct(at, "turns", "sizes")))
    return [F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x.turns)).alias("turns"),
            F.flatten(F.transform(parts, lambda x: x.sizes)).alias("sizes")]


def rebuilt(pieces: DataFrame, convs: DataFrame, group: int = GROUP, kept: int = KEPT, segment: int = SEGMENT) -> DataFrame:
    """(conv, seg, last, turns, sizes, total): segments of each conversation c made of the first h turns of conversation c - c % group, then
    its own after its first h; h = crc32(c) % kept."""
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % kept
    n = F.least(F.col("n"), F.lit(kept) - F.col("at"))
    heads = pieces.where(F.col("at") < kept).select(
        "conv", "at", _cut(F.col("turns"), F.lit(0), n).alias("turns"), F.slice("sizes", F.lit(1), n.cast("int")).alias("sizes")
    ).groupBy(F.col("conv").alias("base")).agg(*_joined("at"))  # at most ``kept`` turns
    info = convs.select("conv", "len", h.alias("h"), (F.col("conv") - F.col("conv") % group).alias("base")).join(heads, "base", "left")
    info = info.withColumn("shared", F.least("h", F.coalesce(F.size("sizes"), F.lit(0)).cast("long")))
    info = store(info.withColumn("total", F.col("shared") + F.greatest(F.lit(0), F.col("len") - F.col("h"))), "trie-rebuilt")

    # conversations without a turn keep an empty part
    first = info.where("shared > 0 OR total = 0").select(
        "conv", "total", F.lit(0).cast("long").alias("at"), F.col("shared").alias("n"),
        F.coalesce(_cut(F.col("turns"), F.lit(0), F.col("shared")), F.lit(b"")).alias("turns"),
        F.coalesce(F.slice("sizes", F.lit(1), F.col("shared").cast("int")), F.array().cast("array<long>")).alias("sizes"))
    skip = F.greatest(F.lit(0), F.col("h") - F.col("at"))
    own = pieces.join(info.select("conv", "total", "h", "shared"), "conv").withColumn("skip", skip).where("skip < n")
    own = own.select("conv", "total", (F.col("at") + F.col("skip") - F.col("h") + F.col("shared")).alias("at"), (F.col("n") - F.col("skip")).alias("n"),
                     _cut(F.col("turns"), F.col("skip"), F.col("n") - F.col("skip")).alias("turns"),
                     F.slice("sizes", (F.col("skip") + 1).cast("int"), (F.col("n") - F.col("skip")).cast("int")).alias("sizes"))
    parts = first.unionByName(own)
    end = F.col("at") + F.greatest(F.col("n"), F.lit(1)) - 1
    cut = parts.withColumn("seg", F.explode(F.sequence(F.floor(F.col("at") / segment), F.floor(end / segment))))
    low = F.greatest(F.lit(0), F.col("seg") * segment - F.col("at"))
    high = F.least(F.col("n"), (F.col("seg") + 1) * segment - F.col("at"))
    cut = cut.withColumns({"low": low, "many": high - low}).select(
        "conv", "total", "seg", (F.col("at") + F.col("low")).alias("at"), _cut(F.col("turns"), F.col("low"), F.col("many")).alias("turns"),
        F.slice("sizes", (F.col("low") + 1).cast("int"), F.col("many").cast("int")).alias("sizes"))
    whole = cut.groupBy("conv", "seg").agg(F.max("total").alias("total"), *_joined("at"))  # at most ``segment`` turns
    last = F.col("seg") == F.floor(F.greatest(F.lit(0), F.col("total") - 1) / segment)
    return whole.withColumn("last", last)


def segments(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv, seg, trie, next, turns, sizes, rest): the trie of each segment, that below its end (null if the conversation ends there), and the
    bytes of the conversation from the segment's start on."""
    own = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    rows = rows.withColumn("bytes", own)
    short = rows.where(F.col("total") <= segment).select(
        "conv", "seg", F.lit(ROOT).alias("trie"), F.lit(None).cast("string").alias("next"), "turns", "sizes", F.col("bytes").alias("rest"))
    # sums of three 40-bit parts of a digest of (segment's number, turns): a string of segments in any split
    digest = F.sha2(F.concat(F.concat(F.col("seg").cast("string"), F.lit(":")).cast("binary"), F.col("turns")), 256)
    words = {f"w{i}": F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 10).cast("long") for i in range(3)}
    by = Window.partitionBy("conv").orderBy("seg")  # a row a segment of long conversations only
    upto = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def key(seg, part):
        return F.sha2(F.concat_ws(":", seg.cast("string"), *(part(f"w{i}").cast("string") for i in range(3))), 256)

    long = rows.where(F.col("total") > segment).withColumns(words).select(
        "*", F.sum("bytes").over(Window.partitionBy("conv").orderBy(F.desc("seg")).rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("rest"),
        *(F.sum(f"w{i}").over(upto).alias(f"s{i}") for i in range(3)))
    after = key(F.col("seg") + 1, lambda w: F.col("s" + w[1]))
    here = key(F.col("seg"), lambda w: F.col("s" + w[1]) - F.col(w))
    long = long.select("conv", "seg", F.when(F.col("seg") == 0, F.lit(ROOT)).otherwise(here).alias("trie"),
                       F.when(~F.col("last"), after).alias("next"), "turns", "sizes", "rest")
    return short.unionByName(long)


# ---------------------------------------------------------------- endings
def _chunked(size: int):
    def run(batches):
        part = path = None
        ids, at = [], 0
        schema = pa.schema([("path", pa.string()), ("part", pa.int32()), ("at", pa.int64()), ("ids", pa.string())])
        for batch in batches:
            out = []
            for p, x, c in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if x != path or len(ids) == size:
                    if ids:
                        out.append((path, part, at, ",".join(ids)))
                    part, path, ids, at = p, x, [], at + 1
                ids.append(str(c))
            if out:
                yield _table(out, schema)
        if ids:
            yield _table([(path, part, at, ",".join(ids))], schema)

    return run


def _hashed(batches):
    """(path, ends) of a stream sorted by (path, part, at): its chunks are hashed one after another."""
    schema = pa.schema([("path", pa.string()), ("ends", pa.string())])
    path = state = None
    for batch in batches:
        out = []
        for x, ids in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
            if x != path:
                if path is not None:
                    out.append((path, state.hexdigest()))
                path, state = x, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if out:
            yield _table(out, schema)
    if path is not None:
        yield _table([(path, state.hexdigest())], schema)


def endings(members: DataFrame, ids: int = IDS) -> DataFrame:
    """(path, ends): the hash of the ids, ascending, of all ``members`` (path, conv) of a path."""
    p = shuffle_partitions(members.sparkSession)
    laid = members.repartitionByRange(p, "path", "conv").sortWithinPartitions("path", "conv").select(F.spark_partition_id().alias("part"), "path", "conv")
    chunks = laid.mapInArrow(_chunked(ids), "path string, part int, at long, ids string")
    return chunks.repartition(p, "path").sortWithinPartitions("path", "part", "at").mapInArrow(_hashed, "path string, ends string")


# ----------------------------------------------------------------- forests
def _path_key(trie: Column, turns: Column) -> Column:
    return F.sha2(F.concat(trie.cast("binary"), F.lit(b"|"), turns), 256)


def node_key(trie: str, turns: bytes) -> str:
    """The key of the node that ``turns`` lead to in ``trie``; the root of a trie is known by the trie's name."""
    return hashlib.sha256(trie.encode() + b"|" + turns).hexdigest() if turns else trie


def shared_turns(a: bytes, b: bytes) -> int:
    """How many turns two strings have in common at their start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // WIDTH
    x, y = np.frombuffer(a[:n], np.uint8), np.frombuffer(b[:n], np.uint8)
    return int(np.argmax(x != y)) // WIDTH


NODES = ("kind int, part int, trie string, depth long, local long, id string, low long, n long, kids long, leaves long, saved long, own long, ends string, "
         "up string, up_low long, border boolean, before long, turns binary, sizes array<long>, leaf boolean")
NODE_ROWS = pa.schema([
    ("kind", pa.int32()), ("part", pa.int32()), ("trie", pa.string()), ("depth", pa.int64()), ("local", pa.int64()), ("id", pa.string()), ("low", pa.int64()), ("n", pa.int64()),
    ("kids", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("own", pa.int64()), ("ends", pa.string()), ("up", pa.string()), ("up_low", pa.int64()),
    ("border", pa.bool_()), ("before", pa.int64()), ("turns", pa.binary()), ("sizes", pa.list_(pa.int64())), ("leaf", pa.bool_())])
FINAL, PARTIAL, FIRST, LAST = range(4)
UP = NODE_ROWS.get_field_index("up")


def forest(part: int, rows: list[dict], shared: int | None, going_on: bool) -> list[tuple]:
    """The nodes of a forest of sorted paths.

    ``shared``: turns that the first path has in common with the path before the forest (None: not known, the caller's
    border); ``going_on``: whether that path was counted as a leaf and the first goes on from it.
    """
    m = len(rows)
    length = [len(r["turns"]) // WIDTH for r in rows]
    sums = [list(accumulate(r["sizes"], initial=0)) for r in rows]
    same = [i > 0 and rows[i]["trie"] == rows[i - 1]["trie"] for i in range(m)]
    lcp = [shared_turns(rows[i - 1]["turns"], rows[i]["turns"]) if same[i] else 0 for i in range(m)]
    # sums over ranges of paths
    n, rest, new, leaves = ([0] for _ in range(4))
    for i, r in enumerate(rows):
        leaf = r["next"] is None and not (i + 1 < m and same[i + 1] and lcp[i + 1] == length[i])
        n.append(n[-1] + r["n"]), rest.append(rest[-1] + r["rest"])
        new.append(new[-1] + sums[i][-1] - sums[i][lcp[i]] + r["more_new"])
        leaves.append(leaves[-1] + leaf + r["more_leaves"])
    root, first, last = list(range(m)), list(range(m)), list(range(m))
    top, kids, low, end = length[:], [0] * m, [r["low"] for r in rows], list(range(m))
    waiting: list[list[int]] = [[] for _ in range(m)]  # finished nodes whose parent is the component's top
    out: list[list] = []

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def finish(c, depth):
        """The chain of component ``c`` from its top up to the child of ``depth``; the last one waits for its parent."""
        a, b = first[c], last[c] + 1
        size = sums[a]
        touches = a == 0 or b == m
        r = rows[a]
        for d in range(top[c], depth, -1):
            at_top = d == top[c]
            stop = rows[end[c]] if at_top and end[c] is not None else None
            leads = stop["next"] if stop is not None else None
            before = size[d - 1] if d else 0
            members = n[b] - n[a]
            fresh = new[b] - new[a] + size[lcp[a]] - before  # the first path is new from here on
            saved = rest[b] - rest[a] - members * before - fresh
            count, under = kids[c] if at_top else 1, leaves[b] - leaves[a]
            if leads is not None:
                count += stop["more_kids"]
            if a == 0 and shared is not None and d <= shared:  # told apart from the forest before
                saved += size[shared] - before
                count -= d < shared
                under -= going_on
            partial = touches or leads is not None
            key = (leads or node_key(r["trie"], r["turns"][:d * WIDTH])) if partial else None
            ends = stop["ends"] if stop is not None else None
            row = [PARTIAL if partial else FINAL, part, r["trie"], r["seg"] * r["segment"] + d, d, key, low[c], members, count, under, saved,
                   size[d] - before, ends, None, None, a == 0 and shared is None, before, None, None, None]
            for child in waiting[c]:
                out[child][UP], out[child][UP + 1] = (key, None) if partial else (None, low[c])
            waiting[c] = [len(out)]
            out.append(row)

    for i in sorted((i for i in range(m) if same[i]), key=lambda i: -lcp[i]):
        a, b, d = find(i - 1), find(i), lcp[i]
        stays = None
        for c in (a, b):
            if top[c] > d:
                finish(c, d)
                top[c], kids[c], end[c] = d, 1, None
            elif end[c] is not None:
                stays = end[c]
        root[b] = a
        last[a], low[a], kids[a], end[a] = last[b], min(low[a], low[b]), kids[a] + kids[b], stays
        waiting[a] += waiting[b]
    for c in (i for i in range(m) if root[i] == i):
        trie = rows[first[c]]["trie"]
        finish(c, -1 if trie == ROOT else 0)
        if trie != ROOT:  # the parent is the node that leads to this trie
            for child in waiting[c]:
                out[child][UP] = trie
    return [tuple(r) for r in out]


def _edge(kind: int, part: int, r: dict) -> tuple:
    values = {"kind": kind, "part": part, "trie": r["trie"], "turns": r["turns"], "sizes": r["sizes"], "leaf": r["next"] is None}
    return tuple(values.get(name) for name in NODE_ROWS.names)


def _forests(chunk: int, segment: int):
    """All forests of a range: its own borders are settled at once, the first one's is left open."""

    def run(batches):
        held, before, part = [], None, None

        def grown():
            if before is None:
                out = [_edge(FIRST, part, held[0])] + forest(part, held, None, False)
            elif before["trie"] != held[0]["trie"]:
                out = forest(part, held, -1, False)
            else:
                common = shared_turns(before["turns"], held[0]["turns"])
                out = forest(part, held, common, before["next"] is None and common * WIDTH == len(before["turns"]))
            return out

        for batch in batches:
            for r in batch.to_pylist():
                if len(held) == chunk:
                    yield from _sliced(grown())
                    before, held = held[-1], []
                part = r["part"]
                held.append(r | {"segment": segment})
        if held:
            yield from _sliced(grown() + [_edge(LAST, part, held[-1])])

    return run


def _sliced(rows: list[tuple], size: int = 8192):
    for at in range(0, len(rows), size):
        yield _table(rows[at:at + size], NODE_ROWS)


BORDERS = "part int, shared long, bytes long, going_on boolean"


def _border(batches):
    """The prefix that a range's first path shares with the last path of the range before."""
    schema = pa.schema([("part", pa.int32()), ("shared", pa.int64()), ("bytes", pa.int64()), ("going_on", pa.bool_())])
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["trie"] == r["last_trie"]:
                n = shared_turns(r["last_turns"], r["turns"])
                out.append((r["part"], n, sum(r["sizes"][:n]), bool(r["last_leaf"]) and n * WIDTH == len(r["last_turns"])))
        if out:
            yield _table(out, schema)


def nodes(paths: DataFrame, chunk: int = CHUNK, segment: int = SEGMENT) -> DataFrame:
    """(trie, depth, local, id, low, n, kids, leaves, saved, own, ends, up_low): every node of all tries but their roots, and the root of all."""
    p = shuffle_partitions(paths.sparkSession)
    laid = paths.repartitionByRange(p, "trie", "turns").sortWithinPartitions("trie", "turns").withColumn("part", F.spark_partition_id())
    made = store(laid.mapInArrow(_forests(chunk, segment), NODES), "trie-nodes")
    # two rows a range
    edges = made.where(F.col("kind").isin(FIRST, LAST)).select("kind", "part", "trie", "turns", "sizes", "leaf")
    by = Window.orderBy("part", "kind")
    previous = edges.select("*", F.lag("trie").over(by).alias("last_trie"), F.lag("turns").over(by).alias("last_turns"), F.lag("leaf").over(by).alias("last_leaf"))
    border = previous.where((F.col("kind") == FIRST) & F.col("last_trie").isNotNull()).mapInArrow(_border, BORDERS)
    partial = made.where(F.col("kind") == PARTIAL).join(F.broadcast(store(border, "trie-borders")), "part", "left")
    crosses = F.col("border") & (F.col("local") <= F.col("shared"))
    partial = partial.withColumn("crosses", F.coalesce(crosses, F.lit(False)))

    def where_shared(x):
        return F.when(F.col("crosses"), x).otherwise(0)

    merged = store(partial.groupBy("trie", "depth", "local", "id").agg(
        F.min("low").alias("low"), F.sum("n").alias("n"), F.sum(F.col("kids") - where_shared((F.col("local") < F.col("shared")).cast("long"))).alias("kids"),
        F.sum(F.col("leaves") - where_shared(F.col("going_on").cast("long"))).alias("leaves"),
        F.sum(F.col("saved") + where_shared(F.col("bytes") - F.col("before"))).alias("saved"), F.max("own").alias("own"), F.max("ends").alias("ends"),
        F.max("up").alias("up"), F.max("up_low").alias("up_low")), "trie-merged")
    columns = ["trie", "depth", "local", "id", "low", "n", "kids", "leaves", "saved", "own", "ends", "up", "up_low"]
    every = made.where(F.col("kind") == FINAL).select(columns).unionByName(merged.select(columns))
    parents = merged.select(F.col("id").alias("up"), F.col("low").alias("parent_low"))
    return every.join(parents, "up", "left").withColumn("up_low", F.coalesce("parent_low", "up_low")).drop("parent_low", "up")


def totals(found: DataFrame, paths: DataFrame) -> DataFrame:
    """(next, more_new, more_leaves, more_kids): what the tries below a node hold, those below them included."""
    own = found.groupBy("trie").agg(F.sum("own").alias("new"), F.sum((F.col("kids") == 0).cast("long")).alias("leaves"),
                                     F.sum((F.col("local") == 1).cast("long")).alias("kids"))
    # a path that leads on is no leaf
    leads = paths.where("next IS NOT NULL").select("next", "trie").distinct()
    lost = leads.groupBy("trie").agg(F.count("*").alias("exits"))
    own = own.join(lost, "trie", "left").select("trie", "new", "kids", (F.col("leaves") - F.coalesce("exits", F.lit(0))).alias("leaves"))
    now = store(own.join(leads.select(F.col("next").alias("trie"), F.col("trie").alias("up")), "trie", "left"), "trie-totals")
    while True:
        sent = now.where("up IS NOT NULL").groupBy(F.col("up").alias("trie")).agg(F.sum("new").alias("more_new"), F.sum("leaves").alias("more_leaves"))
        if now.where("up IS NOT NULL").isEmpty():
            return now.select(F.col("trie").alias("next"), F.col("new").alias("more_new"), F.col("leaves").alias("more_leaves"), F.col("kids").alias("more_kids"))
        further = now.select(F.col("trie").alias("up"), F.col("up").alias("next_up"))
        now = store(now.join(sent, "trie", "left").join(further, "up", "left").select(
            "trie", "kids", (F.col("new") + F.coalesce("more_new", F.lit(0))).alias("new"), (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            F.col("next_up").alias("up")), "trie-totals")


def prefix_trie(table: DataFrame, names=("conv_id", "turn", "role", "text"), group: int = GROUP, kept: int = KEPT, segment: int = SEGMENT,
                chunk: int = CHUNK, ids: int = IDS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    pieces, convs = ordered(table, names, segment)
    rows = store(segments(rebuilt(pieces, convs, group, kept, segment), segment).withColumn("path", _path_key(F.col("trie"), F.col("turns"))), "trie-segments")
    ends = endings(rows.where("next IS NULL").select("path", "conv"), ids)
    paths = rows.groupBy("path", "trie", "turns").agg(
        F.first("seg").alias("seg"), F.first("sizes").alias("sizes"), F.max("next").alias("next"), F.count("*").alias("n"),
        F.min("conv").alias("low"), F.sum("rest").alias("rest"))
    paths = store(paths.join(ends, "path", "left"), "trie-paths")
    none, more = F.lit(0).cast("long"), ("more_new", "more_leaves", "more_kids")
    found = nodes(paths.withColumns({c: none for c in more}), chunk, segment)
    if not paths.where("next IS NOT NULL").isEmpty():  # conversations of more than one segment
        below = totals(store(found, "trie-first"), paths)
        below = paths.where("next IS NOT NULL").select("next").distinct().join(below, "next")
        paths = paths.join(below, "next", "left").withColumns({c: F.coalesce(c, none) for c in more})
        found = nodes(paths, chunk, segment)
    return found.select(
        F.col("low").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.col("up_low")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))


ORACLE = f"""
WITH {CRC_STEPS.strip()},
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS x
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, {crc_sql("encode(CAST(conv_id AS VARCHAR))")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM turns), steps
), parts AS (
  SELECT c.conv_id, 0 AS own, k, x FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 5 AND k <= h
  UNION ALL SELECT c.conv_id, 1, k, x FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND k > h
), whole AS (
  SELECT c.conv_id, coalesce(list(x ORDER BY own, k) FILTER (WHERE k IS NOT NULL), []) AS p FROM convs c LEFT JOIN parts USING (conv_id) GROUP BY c.conv_id
), members AS (
  SELECT conv_id, p, d, p[:d] AS node FROM (SELECT conv_id, p, unnest(range(len(p) + 1)) AS d FROM whole)
), nodes AS (
  SELECT d, node, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(p) = d), '')) AS ends_sha256
  FROM members GROUP BY d, node
), kids AS (
  SELECT node[:d - 1] AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1
), full_nodes AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN d > 0 THEN (n_convs - 1) * strlen(node[d].t) ELSE 0 END AS saves
  FROM nodes n LEFT JOIN kids USING (node)
), below AS (
  SELECT a.node, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves, sum(b.saves) AS saved
  FROM full_nodes a JOIN full_nodes b ON b.d >= a.d AND b.node[:a.d] = a.node GROUP BY a.node
)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN below USING (node) LEFT JOIN nodes p ON n.d > 0 AND p.node = n.node[:n.d - 1]
"""
