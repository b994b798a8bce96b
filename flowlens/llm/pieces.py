"""SentencePiece BPE encoding with an agenda of adjacent symbol pairs, and decoding.

A text is normalised as the vocabulary wants (a blank becomes U+2581, one is
put in front), cut into characters, and the best-scored adjacent pair
that is a piece is merged until none is left: an agenda (heap) holds the
pairs by descending score, then position, and stale entries are skipped.
What is no piece falls back to its UTF-8 bytes.  If no piece of the
vocabulary has U+2581 after another character, merges never cross the
start of a word, so words are encoded apart and remembered in a bounded cache; else the
whole text is one run.  Within a word, two characters that no piece has side by
side are never merged across, so a word that is not remembered is cut there first.

Arrow batches are worked off in slices of about ``SLICE`` characters.  Every
word that is not remembered is encoded by the sentencepiece library too, as are the first
and every tenth 1024 rows' first slice; a difference raises ``ValueError``.  Decoding is the library's.

Defined results: null counts as empty; an empty text has the end id alone
(if asked for); texts of any length are encoded whole; rows keep their
order and number, repeated or not; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import re
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from flowlens.llm.common import column, smaller

SPACE = "▁"
CACHE = 250_000  # words remembered in each of two generations, about 250 bytes each
LONGEST = 64  # longer words are not remembered
SLICE = 1 << 20
WHOLE = 10  # of so many runs of 1024 rows, the first slice is checked whole
KIND = re.compile(f"{SPACE}*\\w+|{SPACE}*[^\\w{SPACE}]+|{SPACE}+")


class Vocabulary:
    """The pieces of a merge-type model file."""

    def __init__(self, path: str, cache: int = CACHE):
        import sentencepiece

        self.cache = cache

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.ids = {sp.id_to_piece(i): i for i in normal}
        places = {score: r for r, score in enumerate(sorted({-sp.get_score(i) for i in normal}))}
        self.rank = {sp.id_to_piece(i): places[-sp.get_score(i)] for i in normal}
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.unknown, self.end = sp.unk_id(), sp.eos_id()
        inner = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.words = re.compile(".+" if inner else f"{SPACE}*[^{SPACE}]+|{SPACE}+", re.S)
        self.pairs = {pair for p in self.ids for pair in zip(p, p[1:])}
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}
        self.parts: dict[str, list[int]] = {}
        self.decimal = [b"%d" % i for i in range(n)]
        self.fresh: list[tuple[str, tuple[int, ...]]] = []

    def merge(self, run: str) -> list[int]:
        """The ids of one run of normalised text."""
        get, symbols, n = self.rank.get, list(run), len(run)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        # An entry is rank * n + position of the left symbol: best score first, then the leftmost.
        agenda = [r * n + i for i in range(n - 1) if (r := get(run[i:i + 2])) is not None]
        heapq.heapify(agenda)
        pop, push = heapq.heappop, heapq.heappush
        while agenda:
            r, i = divmod(pop(agenda), n)
            j = after[i]
            if j < 0 or not symbols[i]:
                continue
            pair = symbols[i] + symbols[j]
            if get(pair) != r:
                continue  # stale: one of the two has been merged meanwhile
            symbols[i], symbols[j] = pair, ""
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (r := get(pair + symbols[k])) is not None:
                    push(agenda, r * n + i)
            h = before[i]
            if h >= 0 and (r := get(symbols[h] + pair)) is not None:
                push(agenda, r * n + h)
        out: list[int] = []
        for s in symbols:
            if s:
                if (found := self.ids.get(s)) is not None:
                    out.append(found)
                elif self.bytes:
                    out.extend(self.bytes[b] for b in s.encode())
                else:
                    out.append(self.unknown)
        return out

    def cut(self, run: str) -> list[int]:
        """The ids of one run; where letters and signs meet and no piece spans the two, its parts are merged apart."""
        held, *parts = KIND.findall(run)
        if not parts:
            return self.merge(run)
        out: list[int] = []
        for p in parts:
            if (held[-1], p[0]) in self.pairs:
                held += p
            else:
                out += self.part(held)
                held = p
        return out + list(self.part(held))

    def part(self, run: str):
        if (known := self.young.get(run)) is not None:
            return known
        found = self.parts.get(run)
        if found is None:
            found = self.merge(run)
            if len(self.parts) >= self.cache // 4:
                self.parts.clear()
            if len(run) <= LONGEST:
                self.parts[run] = found
        return found

    def verify(self) -> None:
        """Compare all words encoded since the last call with the library."""
        fresh = [f for f in self.fresh if len(f[0]) > 1]  # a lone blank cannot be given to the library
        self.fresh = []
        want = self.library.encode([run[1:].replace(SPACE, " ") for run, _ in fresh], out_type=int, num_threads=1)
        for (run, ids), w in zip(fresh, want):
            if list(ids) != w:
                raise ValueError(f"the agenda and the library disagree on {run[:200]!r}")

    def word(self, run: str) -> tuple[int, ...]:
        """The ids of one word, remembered in two generations of bounded size."""
        found = self.old.get(run)
        if found is None:
            found = tuple(self.cut(run))
            self.fresh.append((run, found))
        if len(run) <= LONGEST:
            if len(self.young) >= self.cache:
                self.old, self.young = self.young, {}
            self.young[run] = found
        return found

    def encode(self, text: str) -> list[int]:
        """The ids of a text, without an end id."""
        if not text:
            return []
        get, word = self.young.get, self.word
        return list(chain.from_iterable([get(r) or word(r) for r in self.words.findall(SPACE + text.replace(" ", SPACE))]))

    def decimals(self, ids: list[int]) -> bytes:
        return b" ".join(map(self.decimal.__getitem__, ids))


_LOADED: dict[tuple[str, int], Vocabulary] = {}


def vocabulary(path: str, cache: int = CACHE) -> Vocabulary:
    if (path, cache) not in _LOADED:
        _LOADED[path, cache] = Vocabulary(path, cache)
    return _LOADED[path, cache]


def slices(texts: list[str]):
    """Runs of texts of about SLICE characters (a longer text is alone)."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > SLICE:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end: bool = True,
            with_ids: bool = False, cache: int = CACHE) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids, decoded) of every row."""

    def run(batches):
        # The caches are many small tuples without cycles, which the cyclic collector would walk again and again.
        collecting = gc.isenabled()
        gc.disable()
        try:
            yield from encoded(batches)
        finally:
            if collecting:
                gc.enable()

    def encoded(batches):
        v = vocabulary(path, cache)
        for n, batch in enumerate(smaller(batches)):
            at = 0
            for texts in slices([t or "" for t in batch.column(1).to_pylist()]):
                ids = [v.encode(text) for text in texts]
                if end:
                    for own in ids:
                        own.append(v.end)
                v.verify()
                if not at and n % WHOLE == 0:
                    want = v.library.encode(texts, out_type=int, add_bos=False, add_eos=end, num_threads=1)
                    if ids != want:
                        i = next(i for i, (a, b) in enumerate(zip(ids, want)) if a != b)
                        raise ValueError(f"the agenda and the library disagree on {texts[i][:200]!r}")
                decoded = v.library.decode(ids, num_threads=1)
                columns = [batch.column(0).slice(at, len(texts)), pa.array([len(x) for x in ids], pa.int64()),
                           pa.array([_sha(v.decimals(x)) for x in ids]),
                           pa.array([_sha(d.encode("utf-8", "surrogatepass")) for d in decoded])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns += [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded)]
                    names += ["ids", "decoded"]
                at += len(texts)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if with_ids else "")
    return docs.select(column(id_col).cast("long").alias("doc_id"), column(text_col).alias("text")).mapInArrow(run, schema)
