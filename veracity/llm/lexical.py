"""Ranked lexical search: no-random-access (NRA) reads of impact-sorted lists.

Documents are partitioned, not terms: each task cuts its documents into
segments of bounded size and keeps, per segment, one list per wanted term,
sorted by impact (the term's share of the score).  For an item the lists of
its terms are read sequentially, in growing steps; every document met has a
lower bound (impacts read so far) and an upper bound (plus the last impact
read from every list that has not shown it).  Documents whose upper bound is
below the ``k``-th best lower bound leave; reading goes on until no unread
document can enter and every document left has equal bounds, so that members,
ties and scores are final.  The ``k``-th best score of a task's earlier
segments is where the next one starts, so most lists are hardly read.

Two passes over the documents per block of items: one counts documents, terms
and document frequencies, one reads.  A task sends on at most ``k`` rows per
item, ranked once more over all tasks.  Items are taken in blocks of at most
``BLOCK_TERMS`` distinct terms (one larger item stands alone): that bounds
what is collected, broadcast and kept per task, however many items there are.

Terms are compared by 64-bit hashes.  All scores are 64-bit integers.

Defined cases: null or term-free documents are never found; a null, empty or
term-free item gives no rows; every item row is an item of its own, also
where ids repeat or are null; repeated document rows are ranked each; a null
document id comes last among equal scores; an empty table gives no rows.
Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veracity.llm.columns import doc_columns
from veracity.llm.words import CHUNK_BYTES, NULL_ID, Docs, HashIndex, arrow_map, byte_slices, ids_of, segments
from veracity.session import materialize, scratch_tables

BLOCK_TERMS = 1_000_000
SEGMENT_BYTES = 8 << 20
FIRST_READ, GROWTH = 32, 4

#: A-Z lowered; every ASCII byte that is neither letter nor digit separates terms.
TERMS = np.arange(256, dtype=np.uint8)
TERMS[ord("A"):ord("Z") + 1] += 32
TERMS[[b for b in range(0x80) if not chr(b).isalnum()]] = 0x20

_DF = pa.schema([("term", pa.int64()), ("df", pa.int64())])
_FOUND = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
_ITEM = pa.schema([("item", pa.int64()), ("terms", pa.list_(pa.int64()))])
_ALL_DOCS, _ALL_TERMS = -1, -2


def _item_terms(batch: pa.RecordBatch):
    docs = Docs(batch.column("text"), table=TERMS)
    pairs = np.unique(np.stack([docs.doc_of_word(), docs.hashes().view(np.int64)]), axis=1)
    counts = np.bincount(pairs[0], minlength=batch.num_rows)
    starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return {"item": batch.column("item"), "terms": pa.ListArray.from_arrays(pa.array(starts), pa.array(pairs[1]))}


def _matches(batch: pa.RecordBatch, index: HashIndex) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Wanted terms of a slice as ``doc, term, tf`` (term, then doc, ascending) and the terms of each document."""
    docs, n = Docs(batch.column("text"), table=TERMS), batch.num_rows
    at = index(docs.hashes())
    hit = at < len(index.table)
    key, tf = np.unique(at[hit] * n + docs.doc_of_word()[hit], return_counts=True)
    return key % n, key // n, tf, docs.n_words


def _count(shared):
    def run(batches):
        index = HashIndex(shared.value[0])
        df, n_docs, n_terms = np.zeros(len(index.table), dtype=np.int64), 0, 0
        for part in byte_slices(batches):
            _, term, _, length = _matches(part, index)
            df += np.bincount(term, minlength=len(df))
            n_docs, n_terms = n_docs + int((length > 0).sum()), n_terms + int(length.sum())
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([*seen, _ALL_DOCS, _ALL_TERMS], pa.int64()),
                                          pa.array([*df[seen], n_docs, n_terms], pa.int64())], schema=_DF)

    return run


class Lists:
    """The impact-sorted lists of one segment."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, ids: np.ndarray, n_terms: int):
        order = np.lexsort((-impact, term))
        self.doc, self.impact, self.ids = doc[order], impact[order], ids
        self.start = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.best = np.zeros(n_terms, dtype=np.int64)
        held = np.flatnonzero(np.diff(self.start))
        self.best[held] = self.impact[self.start[held]]

    def search(self, terms: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of every document that can be among the best ``k`` above 0 and reaches ``least``."""
        terms = terms[self.best[terms] > 0]
        if not len(terms) or int(self.best[terms].sum()) < least:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        at, end, step = self.start[terms], self.start[terms + 1], FIRST_READ
        lower = np.zeros(len(self.ids), dtype=np.int64)
        read: list[tuple[np.ndarray, np.ndarray]] = []
        while True:
            count = np.minimum(end - at, step)
            rows = np.repeat(at, count) + segments(count)
            docs = self.doc[rows]
            read.append((docs, np.repeat(np.arange(len(terms)), count)))
            np.add.at(lower, docs, self.impact[rows])
            at, step = at + count, step * GROWTH
            last = np.where(at < end, self.impact[at - 1], 0)  # what an unread entry can add at most
            unread = int(last.sum())
            open_ = np.full(len(lower), unread, dtype=np.int64)
            for seen, which in read:
                np.subtract.at(open_, seen, last[which])
            met = np.flatnonzero(lower)
            worst = least
            if len(met) >= k:
                worst = max(worst, int(np.partition(lower[met], len(met) - k)[len(met) - k]))
            alive = met[lower[met] + open_[met] >= max(worst, 1)]
            if (unread < worst or not unread) and not open_[alive].any():
                best = alive[np.lexsort((self.ids[alive], -lower[alive]))][:k]
                return self.ids[best], lower[best]


class _Best:
    """The best ``k`` of each item so far in a task."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.zeros(items, dtype=np.int64)
        self.ids = [np.zeros(0, dtype=np.int64)] * items
        self.scores = list(self.ids)

    def add(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate([self.ids[i], ids]), np.concatenate([self.scores[i], scores])
        order = np.lexsort((ids, -scores))[:self.k]
        self.ids[i], self.scores[i] = ids[order], scores[order]
        if len(order) == self.k:
            self.least[i] = scores[order[-1]]


def _read(shared, k: int, segment_bytes: int):
    def run(batches):
        table, items, first, terms, weight, n_docs, n_terms = shared.value
        index, best = HashIndex(table), _Best(len(items), k)

        def flush(parts):
            base = np.cumsum([0] + [len(p[3]) for p in parts])
            doc = np.concatenate([p[0] + b for p, b in zip(parts, base)])
            term, tf, length, ids = (np.concatenate([p[j] for p in parts]) for j in (1, 2, 3, 4))
            m = 10 + 90 * length * n_docs // max(n_terms, 1)
            lists = Lists(doc, term, weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc])), ids, len(table))
            for i in range(len(items)):
                ids, scores = lists.search(terms[first[i]:first[i + 1]], k, int(best.least[i]))
                if len(ids):
                    best.add(i, ids, scores)

        parts, held = [], 0
        for part in byte_slices(batches, limit=min(segment_bytes, CHUNK_BYTES)):
            parts.append((*_matches(part, index), ids_of(part)))
            held += part.column("text").nbytes + 64 * part.num_rows
            if held >= segment_bytes:
                flush(parts)
                parts, held = [], 0
        if parts:
            flush(parts)
        for i, item in enumerate(items):
            if len(best.ids[i]):
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(best.ids[i]), pa.int64()), pa.array(best.ids[i]),
                                                  pa.array(best.scores[i])], schema=_FOUND)

    return run


def _search_block(docs: DataFrame, items: list, k: int, segment_bytes: int) -> DataFrame:
    """``item, doc_id, score``: at most ``k`` rows per item and task."""
    context = docs.sparkSession.sparkContext
    terms = [np.array(r["terms"], dtype=np.int64).view(np.uint64) for r in items]
    table = np.unique(np.concatenate(terms)) if terms else np.zeros(0, dtype=np.uint64)
    counted = docs.mapInArrow(_count(context.broadcast((table,))), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = {r["term"]: r["df"] for r in counted.collect()}
    n_docs, n_terms = df.pop(_ALL_DOCS, 0), df.pop(_ALL_TERMS, 0)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(table))],
                      dtype=np.int64)
    first = np.concatenate([[0], np.cumsum([len(t) for t in terms])]).astype(np.int64)
    at = np.searchsorted(table, np.concatenate(terms)) if terms else np.zeros(0, dtype=np.int64)
    shared = context.broadcast((table, np.array([r["item"] for r in items], dtype=np.int64), first, at, weight, n_docs, n_terms))
    return docs.mapInArrow(_read(shared, k, segment_bytes), "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", segment_bytes: int = SEGMENT_BYTES,
           block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents, ties by ascending id."""
    docs = doc_columns(docs, id_col, text_col)
    with scratch_tables() as scratch:
        named = materialize(items.select(items[item_col].cast("long").alias("item_id"),
                                         items[item_text_col].cast("string").alias("text")), "items")
        numbered = named.withColumn("item", F.monotonically_increasing_id())
        pairs = materialize(numbered.mapInArrow(arrow_map(_item_terms, _ITEM), "item long, terms array<long>")
                            .where("size(terms) > 0"), "item-terms")
        blocks = max(1, math.ceil((pairs.agg(F.sum(F.size("terms"))).first()[0] or 0) / block_terms))
        found = None
        for b in range(blocks):
            block = pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).orderBy("item").collect()
            part = _search_block(docs, block, k, segment_bytes)
            found = part if found is None else found.unionByName(part)
        best = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        names = numbered.select("item", "item_id")
        return scratch.keep(materialize(ranked.join(names, "item").select(
            "item_id", "rank", F.nullif("doc_id", F.lit(int(NULL_ID))).alias("doc_id"), "score"), "found"))
