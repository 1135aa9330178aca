"""Token counts by heap-and-linked-list byte-pair merging, without token ids.

The symbols of a unit form a linked list; a heap holds the adjacent pairs that
make a piece, best score first and leftmost among equals.  The top pair is
merged, its two neighbouring pairs are pushed, outdated entries are skipped
when popped.  The number of tokens is the number of initial symbols less the
number of merges; a character no piece holds counts as its UTF-8 bytes and
never merges.

A text is cut where no piece can reach across: before a run of spaces, and
around ASCII bytes that occur in no longer piece (both read from the
vocabulary).  Equal units have equal counts, so the units of a slice are made
distinct by 64-bit hash in numpy and each is merged once; counts of short
units are remembered in two bounded tables, the older of which is forgotten when the newer is full.

The vocabulary is read on the driver from a path given as a parameter and has
a fixed size, so it is broadcast.

Defined cases: null text is empty: no tokens; repeated rows are counted each;
a null id stays null; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from veracity.llm.columns import doc_columns
from veracity.llm.words import RangeHash, _bytes_of, _seeded, arrow_map

MAX_UNITS, UNIT_BYTES = 400_000, 64
SPACE = "▁"
_MARK = SPACE.encode()


def read_pieces(vocabulary: str) -> tuple[str, dict[str, float]]:
    """Digest, and piece -> score, of a byte-pair vocabulary file with byte fallback and plain normalisation."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(vocabulary, "rb") as f:
        raw = f.read()
    model.ParseFromString(raw)
    kind = model.SentencePiece
    normal, trained = model.normalizer_spec, model.trainer_spec
    plain = (normal.add_dummy_prefix and normal.escape_whitespaces and not normal.remove_extra_whitespaces
             and not normal.precompiled_charsmap and not trained.treat_whitespace_as_suffix)
    odd = [p.piece for p in model.pieces if p.type in (kind.USER_DEFINED, kind.UNUSED)]
    if trained.model_type != trained.BPE or not trained.byte_fallback or not plain or odd:
        raise ValueError("a byte-pair vocabulary with byte fallback, a space before the text and no other rules is needed")
    pieces = {p.piece: p.score for p in model.pieces if p.type == kind.NORMAL}
    if any(SPACE in p.lstrip(SPACE) for p in pieces):
        raise ValueError("a piece reaches over a space")
    return hashlib.sha256(raw).hexdigest(), pieces


class Counter:
    """Counts the tokens of units and of whole Arrow columns."""

    def __init__(self, pieces: dict[str, float]):
        self.cost = {p: -s for p, s in pieces.items() if len(p) > 1}
        self.known = {p for p in pieces if len(p) == 1}
        merged = {c for p in self.cost for c in p}
        self.alone = np.array([b < 0x80 and b != 0x20 and chr(b) not in merged for b in range(256)])
        self.units: dict[bytes, int] = {}
        self.older: dict[bytes, int] = {}

    def merge(self, unit: str) -> int:
        """Tokens of one unit, its spaces already marked."""
        symbols: list[str] = list(unit)
        tokens = n = len(symbols)
        cost = self.cost
        if not self.known.issuperset(symbols):
            tokens = sum(1 if c in self.known else len(c.encode()) for c in symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in cost:
                heap.append((cost[pair], i, pair))
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if j >= n or not symbols[i] or symbols[i] + symbols[j] != pair:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = pair, ""
            tokens -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                wider = pair + symbols[k]
                if wider in cost:
                    heapq.heappush(heap, (cost[wider], i, wider))
            h = before[i]
            if h >= 0:
                wider = symbols[h] + pair
                if wider in cost:
                    heapq.heappush(heap, (cost[wider], h, wider))
        return tokens

    def _unit(self, raw: bytes) -> int:
        count = self.units.get(raw)
        if count is None:
            count = self.older.get(raw)
            if count is None:
                count = self.merge(raw.decode().replace(" ", SPACE))
            if len(raw) <= UNIT_BYTES:
                if len(self.units) >= MAX_UNITS:  # units in use come back from the older table
                    self.units, self.older = {}, self.units
                self.units[raw] = count
        return count

    def count(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes and tokens of each text."""
        raw, offsets = _bytes_of(texts)
        n_bytes = np.diff(offsets)
        if len(raw) and _MARK in raw.tobytes():  # the mark itself is a space to the vocabulary
            texts = pa.array([(t or "").replace(SPACE, " ") for t in texts.to_pylist()], pa.large_string())
            raw, offsets = _bytes_of(texts)
        full = np.flatnonzero(np.diff(offsets))
        data = np.insert(raw, offsets[full], 0x20)  # one space before every text that is not empty
        begin = offsets[full] + np.arange(len(full))
        cut = np.zeros(len(data) + 1, dtype=bool)
        space, alone = data == 0x20, self.alone[data]
        cut[:-1] = space | alone
        cut[1:-1] &= ~(space[1:] & space[:-1])
        cut[1:] |= alone
        cut[begin] = cut[-1] = True
        edges = np.flatnonzero(cut)
        start, end = edges[:-1], edges[1:]
        tokens = np.zeros(len(offsets) - 1, dtype=np.int64)
        if len(full):
            hashes = RangeHash(_seeded(0)[0][data], 0)(start, end)
            _, where, which = np.unique(hashes, return_index=True, return_inverse=True)
            whole = data.tobytes()
            distinct = np.array([self._unit(whole[a:b]) for a, b in zip(start[where].tolist(), end[where].tolist())], dtype=np.int64)
            tokens[full] = np.add.reduceat(distinct[which], np.searchsorted(start, begin))
        return n_bytes, tokens


_COUNTED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])
_COUNTERS: dict[str, Counter] = {}


def _counter(key: str, pieces: dict[str, float]) -> Counter:
    """One counter, with its remembered units, per worker process and vocabulary."""
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(pieces)
    return _COUNTERS[key]


def _count(shared, limit: int):
    def fn(batch: pa.RecordBatch):
        n_bytes, tokens = _counter(*shared.value).count(batch.column("text"))
        return {"doc_id": batch.column("doc_id"), "n_bytes": n_bytes, "n_tokens": tokens, "over_limit": tokens > limit}

    return arrow_map(fn, _COUNTED)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per document."""
    docs = doc_columns(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(read_pieces(vocabulary))
    return docs.mapInArrow(_count(shared, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
