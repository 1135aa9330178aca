"""Byte-pair encoding and decoding with a segment tree over adjacent pair ranks.

The leaves of the tree hold the merge rank of each adjacent pair of symbols
(with its position, so equal ranks go to the left); every inner node holds the
least of its two children.  The root is the next merge; a merge changes three
leaves, each updated in logarithmic time, until no mergeable pair is left.  The
trees of many short pretokens are kept as rows of one numpy array and worked on
together, one merge a row at a time; a long one has a tree of its own.  A text is first cut at special tokens and into pretokens, as the vocabulary file
prescribes.

A slice of texts is cut at every space between two characters that are no white
space, where a pretoken always begins.  The pieces are made distinct by 64-bit
hash in numpy; each is encoded once, and the ids of the texts are gathered from
them.  All ids of the slice are decoded together through the vocabulary.  The ids
of recurring pieces and pretokens are remembered by hash in flat arrays, two
bounded tables, for the length of a task; the older is forgotten when the newer is
full.  A slice that decodes to anything but its texts (two pieces of one hash
would do that) is encoded and decoded text by text, without hashes.  At the end
of a task the memory goes back to the system: the worker lives on beside later stages.

The vocabulary is read on the driver from a path given as a parameter and has
a fixed size, so it is broadcast.

Defined cases: null text is empty: no ids, empty decoded text; repeated rows
are encoded each; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from veracity.llm.columns import doc_columns
from veracity.llm.words import RangeHash, _bytes_of, _seeded, arrow_map, released, segments

#: Fixed value: how byte-level vocabularies split text before merging.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MAX_KEPT, KEPT_BYTES = 500_000, 64
LEAVES_AT_ONCE = 1 << 17
_NONE = 1 << 62


@lru_cache(maxsize=1)
def byte_symbols() -> dict[str, int]:
    """Printable character -> byte: printable Latin-1 bytes stand for themselves, the rest follow from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True


def _cuts(data: np.ndarray) -> np.ndarray:
    """Places of spaces whose neighbours, in UTF-8, are no white space."""
    at = np.flatnonzero(data == 0x20)
    at = at[(at > 2) & (at < len(data) - 3)]
    at = at[~_SPACES[data[at - 1]] & ~_SPACES[data[at + 1]]]
    if not len(at) or not (data > 0x7F).any():
        return at
    wide = np.zeros(len(at), dtype=bool)
    before, after = (data[at - 3], data[at - 2], data[at - 1]), (data[at + 1], data[at + 2], data[at + 3])
    for x, y in (before[1:], after[:2]):
        wide |= (x == 0xC2) & ((y == 0x85) | (y == 0xA0))
    for x, y, z in (before, after):
        wide |= (x == 0xE1) & (y == 0x9A) & (z == 0x80)
        wide |= (x == 0xE2) & (y == 0x80) & ((z >= 0x80) & (z <= 0x8A) | (z == 0xA8) | (z == 0xA9) | (z == 0xAF))
        wide |= (x == 0xE2) & (y == 0x81) & (z == 0x9F)
        wide |= (x == 0xE3) & (y == 0x80) & (z == 0x80)
    return at[~wide]


def _gathered(flat: np.ndarray, at: np.ndarray, sizes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` at these places one after the other, and where each document ends in that (``first``: its first run)."""
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    return flat[np.repeat(at - ends[:-1], sizes) + np.arange(ends[-1])], ends[first]


class Remembered:
    """Ids by the hash of their piece: two bounded tables of flat arrays; what is still in use comes back from the older one."""

    def __init__(self, limit: int):
        self.limit = limit
        self.new = self.old = (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32),
                               np.zeros(0, dtype="<u4"))  # sorted hashes, first id, number of ids, ids

    @staticmethod
    def _places(table: tuple, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.searchsorted(table[0], keys)
        hit = place < len(table[0])
        hit[hit] = table[0][place[hit]] == keys[hit]
        return np.flatnonzero(hit), place[hit]

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of those remembered: the first, the number (-1: not remembered), and where they are."""
        at, sizes, parts, base = np.zeros(len(keys), dtype=np.int64), np.full(len(keys), -1, dtype=np.int64), [], 0
        for table in (self.new, self.old):
            rest = np.flatnonzero(sizes < 0)
            hit, place = self._places(table, keys[rest])
            ids, ends = _gathered(table[3], table[1][place], table[2][place], np.arange(len(place) + 1))
            at[rest[hit]], sizes[rest[hit]] = ends[:-1] + base, table[2][place]
            parts.append(ids)
            base += len(ids)
        ids = np.concatenate(parts)
        again = rest[hit]
        self.put(keys[again], at[again], sizes[again], ids)
        return at, sizes, ids

    def put(self, keys: np.ndarray, at: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        keys, one = np.unique(keys, return_index=True)
        known = self._places(self.new, keys)[0]
        keys, one = np.delete(keys, known), np.delete(one, known)
        if not len(keys):
            return
        if len(self.new[0]) + len(keys) > self.limit:
            self.old, self.new = self.new, tuple(x[:0] for x in self.new)
            keys, one = keys[:self.limit], one[:self.limit]
        ids, ends = _gathered(ids, at[one], sizes[one], np.arange(len(one) + 1))
        place = np.searchsorted(self.new[0], keys)
        self.new = (np.insert(self.new[0], place, keys), np.insert(self.new[1], place, ends[:-1] + len(self.new[3])),
                    np.insert(self.new[2], place, sizes[one]), np.concatenate([self.new[3], ids]))


class Bpe:
    """Encoder and decoder for one byte-level vocabulary (the JSON text of a tokenizer file)."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model, before = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or before["type"] != "ByteLevel" or spec["normalizer"] is not None:
            raise ValueError("a byte-level BPE vocabulary without normalizer is needed")
        self.prefix_space = before["add_prefix_space"]
        byte, vocab = byte_symbols(), model["vocab"]
        self.first = [0] * 256
        for char, b in byte.items():
            self.first[b] = vocab[char]
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[left] << 32 | vocab[right]] = (rank << 32, vocab[left + right])
        #: Rank of two single bytes, by both of them.
        self.bytes_rank = [self.merges.get(self.first[i >> 8] << 32 | self.first[i & 255], (_NONE,))[0] for i in range(1 << 16)]
        self.first_of = np.array(self.first, dtype=np.int64)
        self.rank_of_bytes = np.array(self.bytes_rank, dtype=np.int64)
        self.pair_keys = np.array(sorted(self.merges), dtype=np.int64)
        self.pair_ranks, self.pair_made = np.array([self.merges[k] for k in self.pair_keys.tolist()], dtype=np.int64).reshape(-1, 2).T.copy()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in vocab.items():
            self.text[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        for token, i in self.special.items():
            self.text[i] = token.encode()
        self.pieces = np.frombuffer(b"".join(self.text), dtype=np.uint8)
        self.piece_sizes = np.array(list(map(len, self.text)), dtype=np.int64)
        self.piece_at = np.cumsum(self.piece_sizes) - self.piece_sizes
        names = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.split = regex.compile(PRETOKEN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.forget()

    def forget(self) -> None:
        self.kept = Remembered(MAX_KEPT)

    def merge(self, raw: bytes) -> list[int]:
        """All merges of one pretoken, lowest rank first, leftmost among equals."""
        n, first = len(raw), self.first
        symbols = [first[b] for b in raw]
        if n < 2:
            return symbols
        merges, ranks, leaves = self.merges, self.bytes_rank, 1 << (n - 2).bit_length() if n > 2 else 1
        tree = [_NONE] * (2 * leaves)
        for i in range(n - 1):
            rank = ranks[raw[i] << 8 | raw[i + 1]]
            if rank != _NONE:
                tree[leaves + i] = rank + i
        for k in range(leaves - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while tree[1] != _NONE:
            i = tree[1] & 0xFFFFFFFF
            j = after[i]
            k = after[j]
            new = symbols[i] = merges[symbols[i] << 32 | symbols[j]][1]
            symbols[j] = -1
            after[i] = k
            here = left = _NONE
            if k < n:
                before[k] = i
                found = merges.get(new << 32 | symbols[k])
                if found:
                    here = found[0] + i
            changed = [(j, _NONE), (i, here)]
            h = before[i]
            if h >= 0:
                found = merges.get(symbols[h] << 32 | new)
                if found:
                    left = found[0] + h
                changed.append((h, left))
            for at, value in changed:
                at += leaves
                if at >= 2 * leaves or tree[at] == value:
                    continue
                tree[at] = value
                while at > 1:
                    other = tree[at ^ 1]
                    at >>= 1
                    least = value if value < other else other
                    if tree[at] == least:
                        break
                    tree[at] = value = least
        return [s for s in symbols if s >= 0]

    def merge_all(self, raws: list[bytes]) -> list[bytes]:
        """``merge`` for many pretokens of 2 to ``KEPT_BYTES`` bytes, as little-endian ids: one tree a row, all rows at once."""
        out: list[bytes] = [b""] * len(raws)
        sizes = np.array([len(r) for r in raws], dtype=np.int64)
        width = 1 << np.ceil(np.log2(np.maximum(sizes - 1, 1))).astype(np.int64)  # leaves: a power of two for the pairs
        for leaves in np.unique(width).tolist():
            rows = np.flatnonzero(width == leaves)
            step = max(1, LEAVES_AT_ONCE // leaves)
            for at in range(0, len(rows), step):
                some = rows[at:at + step]
                ids, ends = self._merge_rows([raws[r] for r in some], sizes[some], leaves)
                for r, a, b in zip(some.tolist(), [0, *ends[:-1].tolist()], ends.tolist()):
                    out[r] = ids[4 * a:4 * b]
        return out

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the merge of two symbols (none: ``_NONE``) and the symbol it makes."""
        key = left << 32 | right
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        hit = self.pair_keys[at] == key
        return np.where(hit, self.pair_ranks[at], _NONE), self.pair_made[at]

    def _merge_rows(self, raws: list[bytes], n: np.ndarray, leaves: int) -> tuple[bytes, np.ndarray]:
        m, column = len(raws), np.arange(leaves)
        data = np.zeros((m, leaves + 1), dtype=np.int64)
        data[np.repeat(np.arange(m), n), segments(n)] = np.frombuffer(b"".join(raws), dtype=np.uint8)
        symbols = self.first_of[data]
        ranks = self.rank_of_bytes[data[:, :-1] << 8 | data[:, 1:]]
        tree = np.full((m, 2 * leaves), _NONE, dtype=np.int64)
        tree[:, leaves:] = np.where((column < n[:, None] - 1) & (ranks != _NONE), ranks + column, _NONE)
        level = leaves
        while level > 1:
            tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
            level //= 2
        after = np.tile(np.arange(1, leaves + 2), (m, 1))
        before = np.tile(np.arange(-1, leaves), (m, 1))
        row = np.arange(m)
        while True:
            root = tree[row, 1]
            row, root = row[root != _NONE], root[root != _NONE]
            if not len(row):
                break
            i = root & 0xFFFFFFFF
            j = after[row, i]
            k = after[row, j]
            made = self._rank(symbols[row, i], symbols[row, j])[1]
            symbols[row, i] = made
            symbols[row, j] = -1
            after[row, i] = k
            here, left = np.full(len(row), _NONE), np.full(len(row), _NONE)
            more = np.flatnonzero(k < n[row])
            before[row[more], k[more]] = i[more]
            rank = self._rank(made[more], symbols[row[more], k[more]])[0]
            here[more] = np.where(rank != _NONE, rank + i[more], _NONE)
            h = before[row, i]
            some = np.flatnonzero(h >= 0)
            rank = self._rank(symbols[row[some], h[some]], made[some])[0]
            left[some] = np.where(rank != _NONE, rank + h[some], _NONE)
            inside = j < leaves
            for r, place, value in ((row, i, here), (row[inside], j[inside], _NONE), (row[some], h[some], left[some])):
                node = place + leaves
                tree[r, node] = value
                for _ in range(leaves.bit_length() - 1):
                    node = node >> 1
                    tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])
        kept = (symbols >= 0) & (np.arange(leaves + 1) < n[:, None])
        return symbols[kept].astype("<u4").tobytes(), np.cumsum(kept.sum(axis=1))

    def _one(self, raw: bytes) -> bytes:
        return np.array(self.merge(raw), dtype="<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        if self.prefix_space and text and not text.startswith(" "):
            text = " " + text
        return b"".join([self._one(t.encode()) for t in self.split.findall(text)])

    def _pretokens(self, keys: np.ndarray, start: np.ndarray, end: np.ndarray, whole: bytes) -> tuple[np.ndarray, ...]:
        """Ids of pretokens (as ``Remembered.get`` returns them); those not remembered are merged together."""
        at, sizes, ids = self.kept.get(keys)
        wanted = np.flatnonzero(sizes < 0)
        raws = [whole[a:b] for a, b in zip(start[wanted].tolist(), end[wanted].tolist())]
        short = [i for i, raw in enumerate(raws) if 2 <= len(raw) <= KEPT_BYTES]
        merged: list[bytes | None] = [None] * len(raws)
        for i, made in zip(short, self.merge_all([raws[i] for i in short])):
            merged[i] = made
        merged = [self._one(raw) if made is None else made for raw, made in zip(raws, merged)]
        sizes[wanted] = np.array(list(map(len, merged)), dtype=np.int64) // 4
        at[wanted] = len(ids) + np.cumsum(sizes[wanted]) - sizes[wanted]
        ids = np.concatenate([ids, np.frombuffer(b"".join(merged), dtype="<u4")])
        brief = wanted[end[wanted] - start[wanted] <= KEPT_BYTES]
        self.kept.put(keys[brief], at[brief], sizes[brief], ids)
        return at, sizes, ids

    def _units(self, keys: np.ndarray, start: np.ndarray, end: np.ndarray, whole: bytes,
               hashes: RangeHash) -> tuple[np.ndarray, ...]:
        """Ids of pieces of text (as ``Remembered.get`` returns them)."""
        at, sizes, ids = self.kept.get(keys)
        missing = np.flatnonzero(sizes < 0)
        if not len(missing):
            return at, sizes, ids
        cut = [self.split.findall(whole[a:b].decode()) for a, b in zip(start[missing].tolist(), end[missing].tolist())]
        lengths = np.array([len(t) if t.isascii() else len(t.encode()) for texts in cut for t in texts], dtype=np.int64)
        first = np.concatenate([[0], np.cumsum(list(map(len, cut)))])
        before = np.cumsum(lengths) - lengths
        here = before + np.repeat(start[missing] - before[first[:-1]], np.diff(first))
        own, where, which = np.unique(hashes(here, here + lengths), return_index=True, return_inverse=True)
        pre_at, pre_sizes, pre_ids = self._pretokens(own, here[where], (here + lengths)[where], whole)
        made, ends = _gathered(pre_ids, pre_at[which], pre_sizes[which], first)
        at[missing], sizes[missing] = ends[:-1] + len(ids), np.diff(ends)
        ids = np.concatenate([ids, made])
        brief = missing[end[missing] - start[missing] <= KEPT_BYTES]
        self.kept.put(keys[brief], at[brief], sizes[brief], ids)
        return at, sizes, ids

    def encode_all(self, texts: pa.Array) -> tuple[list[np.ndarray], list[str]]:
        """The ids of every text and what they decode to."""
        data, offsets = _bytes_of(texts)
        whole = data.tobytes()
        if self.prefix_space or any(name.encode() in whole for name in self.special):
            return self._one_by_one(texts)
        if not whole:
            return [np.zeros(0, dtype="<u4")] * len(texts), [""] * len(texts)
        start = np.unique(np.concatenate([_cuts(data), offsets[:-1][offsets[:-1] < len(data)]]))
        end = np.append(start[1:], len(data))
        hashes = RangeHash(_seeded(0)[0][data], 0)
        keys, where, which = np.unique(hashes(start, end), return_index=True, return_inverse=True)
        at, sizes, ids = self._units(keys, start[where], end[where], whole, hashes)
        ids, id_ends = _gathered(ids, at[which], sizes[which], np.searchsorted(start, offsets))
        raw, raw_ends = _gathered(self.pieces, self.piece_at[ids], self.piece_sizes[ids], id_ends)
        if not (np.array_equal(raw, data) and np.array_equal(raw_ends, offsets)):
            return self._one_by_one(texts)
        spans = lambda ends: zip(ends[:-1].tolist(), ends[1:].tolist())
        return ([ids[a:b] for a, b in spans(id_ends)],
                [raw[a:b].tobytes().decode("utf-8", errors="replace") for a, b in spans(raw_ends)])

    def _one_by_one(self, texts: pa.Array) -> tuple[list[np.ndarray], list[str]]:
        rows = [self.encode(t or "") for t in texts.to_pylist()]
        return rows, [self.decode(ids.tolist()) for ids in rows]

    def encode(self, text: str) -> np.ndarray:
        """Token ids, as little-endian unsigned 32-bit integers."""
        if self.cut and any(name in text for name in self.special):
            parts = [np.array([self.special[p]], dtype="<u4").tobytes() if p in self.special else self._plain(p)
                     for p in self.cut.split(text)]
            return np.frombuffer(b"".join(parts), dtype="<u4")
        return np.frombuffer(self._plain(text), dtype="<u4")

    def decode(self, ids) -> str:
        return b"".join(map(self.text.__getitem__, ids)).decode("utf-8", errors="replace")


_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                     ("decoded_sha256", pa.string())])
_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
_CODERS: dict[str, Bpe] = {}


def _coder(key: str, source: str) -> Bpe:
    """One coder, with its remembered pieces, per worker process and vocabulary."""
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Bpe(source)
    return _CODERS[key]


def _encode(shared, digest: bool):
    def fn(batch: pa.RecordBatch):
        rows, decoded = _coder(*shared.value).encode_all(batch.column("text"))
        if not digest:
            return {"doc_id": batch.column("doc_id"), "ids": pa.array([x.astype(np.int32) for x in rows], pa.list_(pa.int32())),
                    "decoded": pa.array(decoded, pa.string())}
        sha = lambda raw: hashlib.sha256(raw).hexdigest()
        return {"doc_id": batch.column("doc_id"), "n_tokens": np.array([len(x) for x in rows], dtype=np.int64),
                "ids_sha256": pa.array([sha(x.tobytes()) for x in rows], pa.string()),
                "decoded_sha256": pa.array([sha(t.encode()) for t in decoded], pa.string())}

    encode = arrow_map(fn, _DIGEST if digest else _ENCODED)

    def run(batches):
        with released():  # the worker process lives on, for other stages too
            try:
                yield from encode(batches)
            finally:
                _coder(*shared.value).forget()

    return run


def encode_texts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 digest: bool = False) -> DataFrame:
    """``doc_id, ids, decoded`` per document; with ``digest``, ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    docs = doc_columns(docs, id_col, text_col)
    with open(vocabulary, encoding="utf-8") as f:
        source = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((hashlib.sha256(source.encode()).hexdigest(), source))
    schema = ("doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digest
              else "doc_id long, ids array<int>, decoded string")
    return docs.mapInArrow(_encode(shared, digest), schema)
