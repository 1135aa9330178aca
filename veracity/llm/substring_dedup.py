"""Substring dedup: seed and extend over winnowed anchors.

A repeat is ``window`` (20) or more consecutive words that also start earlier
in the corpus (smaller id, or same document and earlier start).

* **Seed.** Every window selects one anchor: the least hash among its
  ``gram``-word sequences (rightmost on ties).  Equal windows select equal
  anchors, so two documents that share a window share an anchor.  Adjacent
  windows with one anchor form a *span*, the anchor extended both ways to the
  words those windows cover.
* **Join.** Spans meet on the anchor; anchors seen once are dropped.  Anchors
  repeated inside a slice are pre-counted there, so a hot anchor sends one
  count per slice instead of all its rows.
* **Extend.** Equal spans agree in every window: all but the earliest are
  repeats.  Only the earliest spans of anchors with several different spans
  (the two ends of a maximal repeat) are compared window by window.

Maximal repeats are the unions of overlapping repeated windows.  Nothing is
paired: each comparison is a ``min`` per key, combined before the shuffle.

Defined cases: null or empty text has no words; a null id orders after all
others; rows equal in id and text get equal results; rows with one id but
different texts are told apart by a hash of the text; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.llm.columns import doc_columns
from veracity.llm.words import NULL_ID, Docs, RangeHash, arrow_map, ids_of, mix, segments
from veracity.session import materialize

LATER, CHECK = 1, 2

_SPANS = "pk long, anchor long, span long, ord long, th long, a int, n int, seen int, known boolean"
_SPANS_ARROW = pa.schema([("pk", pa.int64()), ("anchor", pa.int64()), ("span", pa.int64()), ("ord", pa.int64()),
                          ("th", pa.int64()), ("a", pa.int32()), ("n", pa.int32()), ("seen", pa.int32()),
                          ("known", pa.bool_())])


def _anchored_spans(docs: Docs, window: int, gram: int):
    """(document, first window, number of windows, anchor hash, span hash) of every span."""
    words = RangeHash(docs.hashes(0), 2)
    n_words = docs.n_words
    n_win = np.maximum(n_words - window + 1, 0)
    starts = np.repeat(docs.first[:-1], n_win) + segments(n_win)  # global word offset of each window
    if not len(starts):
        return None
    last = int(docs.first[-1])
    at = np.arange(last - gram + 1)
    grams = words(at, at + gram)
    width = window - gram + 1
    view = np.lib.stride_tricks.sliding_window_view(grams, width)
    pick = np.empty(len(starts), dtype=np.int64)
    for lo in range(0, len(starts), 1 << 16):
        s = starts[lo:lo + (1 << 16)]
        pick[lo:lo + (1 << 16)] = s + (width - 1) - np.argmin(view[s][:, ::-1], axis=1)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (pick[1:] != pick[:-1]) | (starts[1:] != starts[:-1] + 1)
    head = np.flatnonzero(new)
    n = np.diff(np.append(head, len(starts)))
    a = starts[head]
    doc = np.searchsorted(docs.first, a, side="right") - 1
    return doc, a - docs.first[doc], n, grams[pick[head]], words(a, a + n - 1 + window)


def _spans(window: int, gram: int):
    def fn(batch: pa.RecordBatch):
        found = _anchored_spans(Docs(batch.column("text")), window, gram)
        if found is None:
            return None
        doc, a, n, anchor, span = found
        ord_, th = ids_of(batch, "ord")[doc], np.asarray(batch.column("th"))[doc]
        _, where, counts = np.unique(anchor, return_inverse=True, return_counts=True)
        known = counts[where] > 1
        firsts = np.flatnonzero(known)[np.unique(anchor[known], return_index=True)[1]]  # a witness per repeated anchor
        own = mix(anchor ^ mix(ord_.view(np.uint64) + a.astype(np.uint64)))
        pk = np.where(known, own, anchor)
        zero = np.zeros(len(firsts), dtype=np.int64)
        join = lambda x, y: np.concatenate([x, y])
        return {
            "pk": join(pk, anchor[firsts]).view(np.int64), "anchor": join(anchor, anchor[firsts]).view(np.int64),
            "span": join(span, span[firsts]).view(np.int64), "ord": join(ord_, zero), "th": join(th, zero),
            "a": join(a, zero).astype(np.int32), "n": join(n, zero).astype(np.int32),
            "seen": join(np.ones(len(a), dtype=np.int32), zero.astype(np.int32) + 2),
            "known": join(known, zero.astype(bool)),
        }

    return arrow_map(fn, _SPANS_ARROW)


def _flat_info(column: pa.Array):
    """Owner row, and the fields of every struct in a list column (null lists hold none)."""
    counts = np.asarray(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    flat = column.flatten()
    return np.repeat(np.arange(len(column)), counts), [
        np.asarray(flat.field(i).to_numpy(zero_copy_only=False), dtype=np.int64) for i in range(flat.type.num_fields)]


def _cut(batch: pa.RecordBatch, docs: Docs, doc: np.ndarray, a: np.ndarray, n: np.ndarray, window: int):
    """(words removed, SHA-256 of the words kept) per document."""
    edge = np.zeros(int(docs.first[-1]) + 1, dtype=np.int64)
    np.add.at(edge, docs.first[doc] + a, 1)
    np.add.at(edge, docs.first[doc] + a + n - 1 + window, -1)
    keep = np.cumsum(edge[:-1]) == 0
    before = np.concatenate([[0], np.cumsum(~keep)])
    removed = before[docs.first[1:]] - before[docs.first[:-1]]
    shas, raw = [], docs.data.tobytes()
    for i, gone in enumerate(removed):
        words = raw[docs.offsets[i]:docs.offsets[i + 1]].split()
        if gone:
            words = compress(words, keep[docs.first[i]:docs.first[i + 1]].tolist())
        shas.append(hashlib.sha256(b" ".join(words)).hexdigest())
    return removed, shas


_INFO = "array<struct<a: int, n: int, flag: int>>"
_INFO_ARROW = pa.list_(pa.struct([("a", pa.int32()), ("n", pa.int32()), ("flag", pa.int32())]))
_RESULT = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]


def _first_cut(window: int):
    """Apply the repeats known from equal spans; keep text and spans where windows must still be compared."""

    def fn(batch: pa.RecordBatch):
        docs, info = Docs(batch.column("text")), batch.column("info")
        doc, (a, n, flag) = _flat_info(info)
        later = flag == LATER
        removed, shas = _cut(batch, docs, doc[later], a[later], n[later], window)
        pending = np.zeros(batch.num_rows, dtype=bool)
        pending[doc[flag == CHECK]] = True
        text, kept = batch.column("text").to_pylist(), info.to_pylist()
        return {
            "doc_id": batch.column("doc_id"), "n_words": docs.n_words, "n_removed": removed, "kept_sha256": pa.array(shas),
            "ord": batch.column("ord"), "th": batch.column("th"), "pending": pa.array(pending),
            "text": pa.array([t if p else None for t, p in zip(text, pending)], pa.string()),
            "info": pa.array([t if p else None for t, p in zip(kept, pending)], _INFO_ARROW),
        }

    return arrow_map(fn, pa.schema([*_RESULT, ("ord", pa.int64()), ("th", pa.int64()), ("pending", pa.bool_()),
                                    ("text", pa.string()), ("info", _INFO_ARROW)]))


def _windows(window: int):
    """Both hashes and the place of every window to be compared."""

    def fn(batch: pa.RecordBatch):
        docs = Docs(batch.column("text"))
        doc, (a, n, flag) = _flat_info(batch.column("info"))
        doc, a, n = doc[flag == CHECK], a[flag == CHECK], n[flag == CHECK]
        if not len(a):
            return None
        s = np.repeat(a, n) + segments(n)
        doc = np.repeat(doc, n)
        at = docs.first[doc] + s
        one, two = (RangeHash(docs.hashes(k), k + 2)(at, at + window).view(np.int64) for k in (0, 1))
        return {"w1": one, "w2": two, "ord": np.asarray(batch.column("ord"))[doc],
                "th": np.asarray(batch.column("th"))[doc], "s": s.astype(np.int32)}

    return arrow_map(fn, pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("ord", pa.int64()), ("th", pa.int64()),
                                    ("s", pa.int32())]))


def _second_cut(window: int):
    def fn(batch: pa.RecordBatch):
        docs = Docs(batch.column("text"))
        doc, (a, n, flag) = _flat_info(batch.column("info"))
        more, (s,) = _flat_info(batch.column("more"))
        later = flag == LATER
        removed, shas = _cut(batch, docs, np.concatenate([doc[later], more]), np.concatenate([a[later], s]),
                             np.concatenate([n[later], np.ones(len(s), dtype=np.int64)]), window)
        return {"doc_id": batch.column("doc_id"), "n_words": docs.n_words, "n_removed": removed,
                "kept_sha256": pa.array(shas)}

    return arrow_map(fn, pa.schema(_RESULT))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20,
                   gram: int = 6) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` per document, repeats of ``window`` words cut."""
    docs = doc_columns(docs, id_col, text_col).select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(int(NULL_ID))).alias("ord"), F.xxhash64("text").alias("th"))

    seeds = docs.select("text", "ord", "th").mapInArrow(_spans(window, gram), _SPANS).repartition("pk")
    seeds = seeds.selectExpr("*", "sum(seen) over (partition by pk) as total").where("n > 0 and (known or total > 1)")
    spans = materialize(seeds.select("anchor", "span", "ord", "th", "a", "n"), "repeat-spans")

    first = spans.groupBy("anchor", "span").agg(F.min(F.struct("ord", "a")).alias("first"))
    mixed = first.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select(
        "anchor", F.lit(True).alias("mixed"))
    first = first.join(mixed, "anchor", "left")
    flagged = spans.join(first, ["anchor", "span"]).select(
        "ord", "th", "a", "n",
        F.when(F.struct("ord", "a") > F.col("first"), LATER).when(F.col("mixed"), CHECK).alias("flag"))
    info = (flagged.where("flag is not null").groupBy("ord", "th", "a").agg(F.max("n").alias("n"), F.min("flag").alias("flag"))
            .groupBy("ord", "th").agg(F.collect_list(F.struct("a", "n", "flag")).cast(_INFO).alias("info")))
    cut = materialize(
        docs.join(info, ["ord", "th"], "left").select("doc_id", "text", "ord", "th", "info").mapInArrow(
            _first_cut(window), "doc_id long, n_words long, n_removed long, kept_sha256 string, ord long, th long, "
                                f"pending boolean, text string, info {_INFO}"), "repeat-cut")

    pending = cut.where("pending")
    windows = pending.select("text", "info", "ord", "th").mapInArrow(
        _windows(window), "w1 long, w2 long, ord long, th long, s int")
    earliest = windows.groupBy("w1", "w2").agg(F.min(F.struct("ord", "s")).alias("first"))
    more = (windows.join(earliest, ["w1", "w2"]).where(F.struct("ord", "s") > F.col("first"))
            .select("ord", "th", "s").distinct()
            .groupBy("ord", "th").agg(F.collect_list(F.struct("s")).alias("more")))
    result = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    rest = pending.select("doc_id", "text", "info", "ord", "th").join(more, ["ord", "th"], "left").select(
        "doc_id", "text", "info", "more").mapInArrow(_second_cut(window), result)
    return cut.where("not pending").select("doc_id", "n_words", "n_removed", "kept_sha256").unionByName(rest)
