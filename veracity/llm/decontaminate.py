"""Benchmark decontamination by latent semantic retrieval.

* **Index.** Benchmark passages, in pieces of about ``PIECE`` words, become
  TF-IDF rows over hashed terms (a fixed number of buckets); a randomised SVD,
  its products computed by Spark over the passages, gives a latent basis: the
  fewest dimensions that hold ``ENERGY`` of the rows' squared length, at most
  half as many as there are rows and at most ``RANK``.  The inverse frequencies
  are those of the benchmark, so a passage leaked into a third of the corpus
  loses no weight.
* **Search.** Every document is cut into half-overlapping windows over its
  whole text.  A window whose weight on benchmark terms bounds its cosine
  below the threshold is passed over; the others are projected and compared
  with all pieces in the latent space by one matrix product; a cosine of
  ``MEANING`` makes a candidate, so a window meets pieces whose terms go
  together with its own.  What the reduced space hides of a piece cannot be
  lost: the exact sparse TF-IDF cosine adds the pieces that reach ``COSINE`` by it (rarer terms are looked up, and what the
  common ones could add bounds the rest), however large the benchmark is.
* **Checks.** Around each candidate, the longest common subsequence with the
  passage must cover most of it, and its answer (the last sentence) must be
  there too; a nearly complete subsequence is enough by itself.  A paraphrase
  keeps less of the order: a latent candidate is confirmed by a subsequence of
  ``REWORDED`` and nearly the whole answer, too.

A document takes part in one task only, so nothing is shuffled but matches.
The benchmark is taken in blocks of ``BLOCK_ITEMS`` passages, each broadcast
by itself, so what tasks hold stays bounded however large it grows.

Defined cases: null or empty texts and passages match nothing; a null
``item_id`` is reported as null; equal passages are all reported; repeated rows
are reported once per id; extra columns are ignored (and kept by
``drop_leaks``); with an empty benchmark nothing matches.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.llm.columns import doc_columns
from veracity.llm.words import LETTERS, Docs, arrow_map, byte_slices, segments

BUCKETS, RANK, POWER_STEPS, WINDOW = 1 << 16, 256, 3, 32
COSINE, SUBSEQUENCE, ANSWER, NEARLY_ALL = 0.22, 0.6, 0.5, 0.85
MEANING, REWORDED, WHOLE_ANSWER = 0.4, 0.3, 0.8
ENERGY, PIECE = 0.6, 96
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 64 << 20
STEP = WINDOW // 2
COMMON, CELLS, SUM_TERMS, SUM_TASKS = 1 / 64, 1 << 21, 1 << 10, 8

_SUM_SCHEMA = "part int, rows long, sums binary"


def _words(texts: pa.Array) -> Docs:
    """Lower-cased words without ASCII punctuation, so case and punctuation hide nothing."""
    return Docs(pc.utf8_lower(texts.cast(pa.large_string())), table=LETTERS)


def _terms(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1)


def _pieces(docs: Docs):
    """(piece of each word, passage of each piece): passages in even pieces of about ``PIECE`` words, at least one each."""
    n = docs.n_words
    count = np.maximum((n + PIECE // 2) // PIECE, 1)
    doc = docs.doc_of_word()
    at = np.arange(len(doc)) - docs.first[doc]
    return (np.cumsum(count) - count)[doc] + at * count[doc] // np.maximum(n, 1)[doc], np.repeat(np.arange(len(n)), count)


def _rows(docs: Docs, idf: np.ndarray):
    """TF-IDF rows of unit length: (row, term, value) of the distinct terms of each piece, and the passage of each row."""
    piece, passage = _pieces(docs)
    cell, tf = np.unique(piece * BUCKETS + _terms(docs.hashes()), return_counts=True)
    row, term = cell // BUCKETS, cell % BUCKETS
    value = tf * idf[term]
    norm = np.sqrt(np.bincount(row, value * value, len(passage)))
    return row, term, value / np.maximum(norm, 1e-12)[row], passage


_DF = pa.schema([("term", pa.int32()), ("df", pa.int64())])
_SUM = pa.schema([("part", pa.int32()), ("rows", pa.int64()), ("sums", pa.binary())])


def _df(batch: pa.RecordBatch):
    docs = _words(batch.column("text"))
    cell = np.unique(docs.doc_of_word() * BUCKETS + _terms(docs.hashes()))
    term, df = np.unique(cell % BUCKETS, return_counts=True)
    return {"term": term.astype(np.int32), "df": df}


def _gram_product(shared):
    """A' (A q) over the passages of a task, in parts of ``SUM_TERMS`` terms: the one pass a randomised SVD repeats."""

    def run(batches):
        used, idf, q = shared.value
        total, n = np.zeros(q.shape), 0
        for batch in byte_slices(batches):
            row, term, value, passage = _rows(_words(batch.column("text")), idf)
            term, n = used[term], n + len(passage)
            projected = np.zeros((len(passage), q.shape[1]))
            np.add.at(projected, row, value[:, None] * q[term])
            np.add.at(total, term, value[:, None] * projected[row])
        for part, lo in enumerate(range(0, len(total), SUM_TERMS)):
            yield pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([n if part == 0 else 0], pa.int64()),
                pa.array([total[lo:lo + SUM_TERMS].tobytes()], pa.binary())], schema=_SUM)

    return run


def _sum_parts(group: pd.DataFrame) -> pd.DataFrame:
    """Sums of one part over all tasks, added in an order of their own."""
    sums = sum(np.frombuffer(b) for b in sorted(group["sums"]))
    return pd.DataFrame({"part": group["part"].iloc[:1], "rows": [group["rows"].sum()], "sums": [sums.tobytes()]})


class Index:
    """Latent basis, projected passages and the passages themselves for the checks: bounded by a block of items."""

    def __init__(self, items: list, idf: np.ndarray, used: np.ndarray, basis: np.ndarray, unseen: float):
        self.ids = [r["item_id"] for r in items]
        self.texts = [r["text"] for r in items]
        self.idf, self.used, self.unseen = idf.astype(np.float32), used, unseen
        self.basis = np.vstack([basis, np.zeros((1, basis.shape[1]))]).astype(np.float32)  # last row: unknown terms
        docs = _words(pa.array(self.texts, pa.string()))
        row, term, value, self.passage = _rows(docs, idf)
        latent = np.zeros((len(self.passage), basis.shape[1]))
        np.add.at(latent, row, value[:, None] * self.basis[used[term]])
        self.latent = (latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)).T.astype(np.float32)
        self.sparse = Sparse(len(self.passage), row, term, value)
        hashes = docs.hashes()
        self.words = [hashes[lo:hi].tolist() for lo, hi in zip(docs.first[:-1], docs.first[1:])]
        self.answers = [_answer(text, len(w)) for text, w in zip(self.texts, self.words)]


class Sparse:
    """Exact cosines of windows to the ``n`` pieces whose rows are given: postings of a bounded number of pieces."""

    def __init__(self, n: int, row: np.ndarray, term: np.ndarray, value: np.ndarray):
        self.n, self.cell, self.value = n, row * BUCKETS + term, value  # cells ascend
        order = np.argsort(term, kind="stable")
        self.posted, self.weight = row[order], value[order]
        self.first = np.searchsorted(term[order], np.arange(BUCKETS + 1))
        self.common = np.diff(self.first) > max(16, COMMON * n)
        self.rest = np.sqrt(np.bincount(row, np.where(self.common[term], value * value, 0), n))

    def near(self, term: np.ndarray, w: np.ndarray, norm: np.ndarray):
        """(window, piece, cosine) of all that reach the threshold; rows of ``term`` and ``w`` are windows."""
        at, width = [], max(1, CELLS // self.n)
        for lo in range(0, len(term), width):
            at += [(lo + i, j, c) for i, j, c in self._near(term[lo:lo + width], w[lo:lo + width], norm[lo:lo + width])]
        return at

    def _near(self, term, w, norm):
        n, common = self.n, self.common[term]
        spare = np.sqrt((np.where(common, w, 0) * _alike(term, w)).sum(axis=1))  # length of a window's common part
        full = spare * self.rest.max() >= COSINE * norm  # common terms alone could reach the threshold
        spare = np.where(full, 0, spare)
        win, pos = np.nonzero((w > 0) & (~common | full[:, None]))
        t, total = term[win, pos], np.zeros(len(term) * n)
        count = self.first[t + 1] - self.first[t]
        cut = np.searchsorted(np.cumsum(count), np.arange(0, int(count.sum()) + CELLS, CELLS), side="right")
        for lo, hi in zip(cut[:-1], cut[1:]):
            post = np.repeat(self.first[t[lo:hi]], count[lo:hi]) + segments(count[lo:hi])
            total += np.bincount(np.repeat(win[lo:hi], count[lo:hi]) * n + self.posted[post],
                                 np.repeat(w[win[lo:hi], pos[lo:hi]], count[lo:hi]) * self.weight[post], len(total))
        least = COSINE * norm[:, None] - 1e-9
        i, j = np.nonzero(total.reshape(-1, n) + spare[:, None] * self.rest >= least)
        out = []
        for lo in range(0, len(i), 1 << 15):
            a, b = i[lo:lo + (1 << 15)], j[lo:lo + (1 << 15)]
            cell = b[:, None] * BUCKETS + term[a]
            place = np.minimum(np.searchsorted(self.cell, cell), len(self.cell) - 1)
            cosine = (np.where(self.cell[place] == cell, self.value[place], 0) * w[a]).sum(axis=1) / np.maximum(norm[a], 1e-9)
            out += [x for x in zip(a.tolist(), b.tolist(), cosine.tolist()) if x[2] >= COSINE]
        return out


def _alike(term: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sum of the weights of each word's equals in its window."""
    return np.einsum("ijk,ik->ij", term[:, :, None] == term[:, None, :], w)


def _answer(text: str, n: int) -> int:
    """Number of words in the last sentence (at least three, at most all)."""
    sentences = [s for s in text.replace("!", ".").replace("?", ".").split(".") if s.strip()]
    last = _words(pa.array([sentences[-1] if sentences else ""])).n_words[0]
    return int(min(max(last, 3), n))


def _common(passage: list[int], region: list[int]) -> int:
    """Length of the longest common subsequence, one machine word of bits per step."""
    where: dict[int, int] = {}
    for i, w in enumerate(passage):
        where[w] = where.get(w, 0) | 1 << i
    row, full = (1 << len(passage)) - 1, (1 << len(passage)) - 1
    for w in region:
        hit = row & where.get(w, 0)
        row = (row + hit | row - hit) & full
    return len(passage) - bin(row).count("1")


def _search(index: Index, docs: Docs):
    """(document, item, cosine, subsequence share, answer share) of every confirmed passage."""
    hashes, n = docs.hashes(), docs.n_words
    if not len(hashes):
        return []
    term = _terms(hashes)
    weight = np.where(index.idf[term] > 0, index.idf[term], index.unseen)
    known = np.where(index.idf[term] > 0, weight * weight, 0).astype(np.float64)
    sums = [np.concatenate([[0], np.cumsum(v)]) for v in (known, weight.astype(np.float64) ** 2)]
    n_win = np.where(n > 0, np.maximum(-(-(n - STEP) // STEP), 1), 0)
    doc = np.repeat(np.arange(len(n)), n_win)
    lo = docs.first[doc] + segments(n_win) * STEP
    hi = np.minimum(lo + WINDOW, docs.first[doc + 1])
    bound = sums[0][hi] - sums[0][lo] >= COSINE * COSINE * (sums[1][hi] - sums[1][lo])
    doc, lo, hi, found = doc[bound], lo[bound], hi[bound], {}
    for at in range(0, len(lo), 1024):
        a, b = lo[at:at + 1024], hi[at:at + 1024]
        place = a[:, None] + np.arange(WINDOW)
        inside = place < b[:, None]
        place = np.where(inside, place, 0)
        w = np.where(inside, weight[place], 0)
        same = hashes[place][:, :, None] == hashes[place][:, None, :]
        norm = np.sqrt(np.einsum("ij,ijk,ik->i", w, same, w))
        rows = np.where(inside, index.used[term[place]], len(index.basis) - 1)
        latent = np.einsum("ij,ijk->ik", w, index.basis[rows])
        cosine = (latent @ index.latent) / np.maximum(norm, 1e-9)[:, None]
        i, j = np.nonzero(cosine >= MEANING)
        near = zip(i.tolist(), j.tolist(), cosine[i, j].tolist())
        for latent_hit, hits in ((True, near), (False, index.sparse.near(term[place], w.astype(np.float64), norm))):
            for i, j, c in hits:
                best = found.setdefault((int(doc[at + i]), int(index.passage[j])), {}).setdefault((int(a[i]), int(b[i])), [0.0, 0.0])
                best[not latent_hit] = max(best[not latent_hit], c)
    out = []
    for (d, item), hits in found.items():
        passage, best = index.words[item], None
        for (a, b), (latent, exact) in sorted(hits.items(), key=lambda hit: (-max(hit[1]), hit[0])):
            region = hashes[max(docs.first[d], a - len(passage)):min(docs.first[d + 1], b + len(passage))].tolist()
            share = _common(passage, region) / len(passage)
            if share >= (REWORDED if latent else SUBSEQUENCE) and (best is None or share > best[1]):
                answer = _common(passage[-index.answers[item]:], region) / index.answers[item]
                if share >= NEARLY_ALL or answer >= (ANSWER if share >= SUBSEQUENCE else WHOLE_ANSWER):
                    best = (max(latent, exact), share, answer)
                    if share >= NEARLY_ALL:
                        break
        if best:
            out.append((d, item, *best))
    return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str):
    """Passages block by block; the usual benchmark is one block."""
    items = benchmark.select(benchmark[id_col].cast("long").alias("item_id"), benchmark[text_col].cast("string").alias("text"))
    items = items.where(F.length(F.trim("text")) > 0)
    size = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(-(-size["n"] // BLOCK_ITEMS), -(-(size["bytes"] or 0) // BLOCK_BYTES))
    for k in range(blocks):
        yield items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)


def build_index(items: DataFrame) -> Index | None:
    """TF-IDF, randomised SVD (products by Spark, the small factorisations in numpy) and projection of one block."""
    spark = items.sparkSession
    rows = items.orderBy("item_id", "text").collect()  # one block, bounded
    df = np.zeros(BUCKETS)
    for r in items.select("text").mapInArrow(arrow_map(_df, _DF), "term int, df long").groupBy("term").agg(
            F.sum("df").alias("df")).collect():  # at most BUCKETS rows
        df[r["term"]] = r["df"]
    if not df.any():
        return None
    idf = np.where(df > 0, np.log(1 + len(rows) / np.maximum(df, 1)), 0)
    terms = int((df > 0).sum())
    used = np.full(BUCKETS, terms)
    used[df > 0] = np.arange(terms)
    q = np.linalg.qr(np.random.default_rng(23).normal(size=(terms, min(RANK, terms))))[0]
    for _ in range(POWER_STEPS):
        shared = spark.sparkContext.broadcast((used, idf, q))
        parts = items.select("text").coalesce(SUM_TASKS).mapInArrow(_gram_product(shared), _SUM_SCHEMA)
        parts = parts.groupBy("part").applyInPandas(_sum_parts, _SUM_SCHEMA).orderBy("part").collect()  # one matrix like q
        shared.unpersist()
        total = np.concatenate([np.frombuffer(r["sums"]) for r in parts]).reshape(q.shape)
        energy, turn = np.linalg.eigh(q.T @ total)
        energy, q = np.maximum(energy[::-1], 0), np.linalg.qr(total @ turn[:, ::-1])[0]
    pieces = sum(r["rows"] for r in parts)  # as many as the squared length of all rows
    rank = int(np.searchsorted(np.cumsum(energy), ENERGY * pieces)) + 1
    q = q[:, :max(1, min(rank, pieces // 2))]
    return Index(rows, idf, used, q, float(np.log(1 + len(rows))))


_MATCH = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("cosine", pa.float64()), ("subsequence", pa.float64()),
                    ("answer", pa.float64())])


def _matches(shared):
    def fn(batch: pa.RecordBatch):
        index = shared.value
        hits = _search(index, _words(batch.column("text")))
        if not hits:
            return None
        doc, item, *scores = zip(*hits)
        return {"doc_id": batch.column("doc_id").take(pa.array(doc)),
                "item_id": pa.array([index.ids[i] for i in item], pa.int64())} | {
            k: pa.array(v, pa.float64()) for k, v in zip(("cosine", "subsequence", "answer"), scores)}

    return arrow_map(fn, _MATCH)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", passage_col: str = "text") -> DataFrame:
    """``doc_id, item_id, cosine, subsequence, answer``: one row per document and benchmark passage found in it."""
    docs = doc_columns(docs, id_col, text_col)
    spark, schema = docs.sparkSession, "doc_id long, item_id long, cosine double, subsequence double, answer double"
    found = spark.createDataFrame([], schema)
    for items in _blocks(benchmark, item_col, passage_col):
        index = build_index(items)
        if index is not None:
            found = found.unionByName(docs.mapInArrow(_matches(spark.sparkContext.broadcast(index)), schema))
    return found.groupBy("doc_id", "item_id").agg(*(F.max(c).alias(c) for c in ("cosine", "subsequence", "answer")))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
               passage_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark passage; all columns kept, nothing shuffled."""
    spark = docs.sparkSession
    for items in _blocks(benchmark, item_col, passage_col):
        index = build_index(items)
        if index is not None:
            docs = docs.mapInArrow(_clean(spark.sparkContext.broadcast(index), text_col), docs.schema)
    return docs


def _clean(shared, text_col: str):
    def run(batches):
        for batch in byte_slices(batches, text_col):
            leaked = {d for d, *_ in _search(shared.value, _words(batch.column(text_col)))}
            if leaked:
                batch = batch.filter(pa.array([i not in leaked for i in range(batch.num_rows)]))
            yield batch

    return run
