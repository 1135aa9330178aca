"""Quality classifier: random-indexing word vectors, pooled, into a two-layer network.

* **Random indexing.** Every word has a fixed sparse random index vector.  The
  vector of one of the ``TOP`` most frequent words is the sum of the index
  vectors of its neighbours over the whole corpus, centred and scaled.  Every
  word, however rare, also has the mean of the index vectors of its three-byte
  pieces (white space marks word ends), so unseen words have vectors too.
* **Pooling.** A document is the mean of its words' vectors, over its whole
  text, beside a few shape rates (capitals, digits, word length, repeated words).
* **Network.** Two layers in numpy, fitted on at most ``SAMPLE`` labelled rows
  (the least hashes of their ids: the same rows wherever they are stored); a
  sixth of them is held back to choose the temperature that calibrates the
  probabilities.

Counts and neighbours cover all documents; only the network is fitted on a
sample.  Labels, language, source and id never enter a score.

Defined cases: null or empty text is scored from empty features; labels that
are null, or whose document is missing, are not learned from; without labels,
or with one class only, the score is the share of good labels (0.5 without);
repeated rows and extra columns are harmless.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.llm.columns import crc_bucket, doc_columns
from veracity.llm.words import Docs, HashIndex, arrow_map, byte_slices, mix, top_words

TOP, WORD_DIM, PIECE_DIM, PIECES, WINDOW = 2048, 48, 96, 1 << 15, 2
SAMPLE, HIDDEN, EPOCHS, DECAY, THRESHOLD = 24_000, 32, 16, 4e-3, 0.3
SHAPES = 10


def _index_vectors(rows: int, dim: int, seed: int) -> np.ndarray:
    """Sparse ternary rows: four entries of +-1."""
    rng = np.random.default_rng(seed)
    out = np.zeros((rows, dim), dtype=np.float32)
    for _ in range(4):
        out[np.arange(rows), rng.integers(0, dim, rows)] += rng.choice([-0.5, 0.5], rows)
    return out


def _word_index_vectors(words: np.ndarray, dim: int) -> np.ndarray:
    """Sparse ternary rows like those of ``_index_vectors``, each from the hash of its own word: no other word moves them."""
    out = np.zeros((len(words), dim), dtype=np.float64)
    for i in range(4):
        drawn = mix(words + np.uint64(2 * i + 1))
        out[np.arange(len(words)), (drawn % np.uint64(dim)).astype(np.int64)] += np.where(drawn >> np.uint64(63), 0.5, -0.5)
    return out


_NEAR = pa.schema([("part", pa.int32()), ("sums", pa.binary())])


def _neighbours(shared):
    """Per task: how often each top word has each other within the window, projected on index vectors."""

    def run(batches):
        words, pairs, rows = shared.value, None, 0
        place = HashIndex(words)
        for batch in byte_slices(batches):
            docs = Docs(batch.column("text"), lower=True)
            if pairs is None:
                pairs = np.zeros((len(words) + 1) ** 2, dtype=np.int32)
            ids, owner = place(docs.hashes()), docs.doc_of_word()
            for step in range(1, WINDOW + 1):
                near = owner[step:] == owner[:-step]
                flat = ids[step:][near] * (len(words) + 1) + ids[:-step][near]
                np.add.at(pairs, flat, 1)
            rows += batch.num_rows
        if rows:
            table = pairs.reshape(len(words) + 1, -1).astype(np.float64)
            sums = (table + table.T)[:-1, :-1] @ _word_index_vectors(words, WORD_DIM)
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % 16], pa.int32()), pa.array([sums.tobytes()], pa.binary())],
                                             schema=_NEAR)

    return run


def _add(batches):
    total, part = None, 0
    for batch in batches:
        for p, raw in zip(*(batch.column(i).to_pylist() for i in range(2))):
            total, part = np.frombuffer(raw) + (0 if total is None else total), p
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())], schema=_NEAR)


def word_vectors(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the top words and their vectors, from all texts; both of a fixed size."""
    spark = texts.sparkSession
    words = top_words(texts, TOP)[0]
    sums = texts.mapInArrow(_neighbours(spark.sparkContext.broadcast(words)), "part int, sums binary")
    sums = sums.repartition(16, "part").mapInArrow(_add, "part int, sums binary").collect()  # at most 16 rows
    vectors = sum((np.frombuffer(r["sums"]) for r in sums), np.zeros(len(words) * WORD_DIM)).reshape(len(words), WORD_DIM)
    if len(words):
        vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        vectors = vectors - vectors.mean(axis=0)
    return words, np.vstack([vectors, np.zeros((1, WORD_DIM))]).astype(np.float32)


class Pooler:
    """Features of whole texts: pooled word vectors, pooled piece vectors, shape rates."""

    def __init__(self, words: np.ndarray, vectors: np.ndarray):
        self.words, self.place, self.vectors, self.pieces = words, HashIndex(words), vectors, _index_vectors(PIECES, PIECE_DIM, 7)

    def __call__(self, texts: pa.Array) -> np.ndarray:
        lower, plain = Docs(texts, lower=True), Docs(texts)
        n, rows = lower.n_words, len(texts)
        hashes, owner = lower.hashes(), lower.doc_of_word()
        ids = self.place(hashes)
        out = np.zeros((rows, WORD_DIM + PIECE_DIM + SHAPES), dtype=np.float32)
        known = ids < len(self.words)
        for i, (lo, hi) in enumerate(zip(lower.first[:-1], lower.first[1:])):
            if hi > lo:
                out[i, :WORD_DIM] = np.bincount(ids[lo:hi], minlength=len(self.words) + 1) @ self.vectors
        out[:, :WORD_DIM] /= np.maximum(np.bincount(owner, known, rows), 1)[:, None]
        data = np.where(lower.data <= 0x20, 0x20, lower.data).astype(np.uint64)
        code = mix(data[:-2] | data[1:-1] << np.uint64(8) | data[2:] << np.uint64(16)) if len(data) > 2 else data[:0]
        bucket, size = (code & np.uint64(PIECES - 1)).astype(np.int64), np.diff(lower.offsets)
        for i, (lo, hi) in enumerate(zip(lower.offsets[:-1], lower.offsets[1:])):
            if hi - lo > 2:
                found, counts = np.unique(bucket[lo:hi - 2], return_counts=True)
                out[i, WORD_DIM:-SHAPES] = counts.astype(np.float32) @ self.pieces[found] / (hi - lo)
        per_byte = lambda mask: _sums(mask, lower.offsets) / np.maximum(size, 1)
        raw = plain.data
        shapes = [per_byte((raw >= 65) & (raw <= 90)), per_byte((raw >= 48) & (raw <= 57)), per_byte(raw >= 128),
                  per_byte((raw > 32) & (raw < 48)), per_byte(raw == 10), n / np.maximum(size, 1) * 4,
                  np.log1p(n) / 10, np.bincount(owner, known, rows) / np.maximum(n, 1)]
        again = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
        kinds = owner[np.unique(mix(hashes + owner.astype(np.uint64)), return_index=True)[1]]
        shapes += [np.bincount(owner[1:], again, rows) / np.maximum(n, 1),
                   np.bincount(kinds, minlength=rows) / np.maximum(n, 1)]
        out[:, -SHAPES:] = np.column_stack(shapes)
        return out


def _sums(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return total[offsets[1:]] - total[offsets[:-1]]


class Network:
    """One hidden layer, logistic output, probabilities calibrated by one temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.constant = None if len(np.unique(y)) == 2 else float(y.mean()) if len(y) else 0.5
        if self.constant is not None:
            return
        held = np.arange(len(y)) % 6 == 0
        if len(np.unique(y[~held])) < 2 or len(np.unique(y[held])) < 2:
            held[:] = False
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = (x - self.mean) / self.scale
        rng = np.random.default_rng(17)
        self.w = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        self._fit(x[~held], y[~held], rng)
        test = held if held.any() else ~held
        z = self._logit(x[test])
        choices = np.geomspace(1, 8, 25)
        loss = [np.mean(np.logaddexp(0, z / t) - y[test] * z / t) for t in choices]
        self.temperature = float(choices[int(np.argmin(loss))])

    def _logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3][0]

    def _fit(self, x: np.ndarray, y: np.ndarray, rng) -> None:
        m, v, t = [0 * w for w in self.w], [0 * w for w in self.w], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(y))
            for lo in range(0, len(y), 128):
                a, b = x[order[lo:lo + 128]], y[order[lo:lo + 128]]
                h = np.tanh(a @ self.w[0] + self.w[1])
                e = (1 / (1 + np.exp(-(h @ self.w[2] + self.w[3][0]))) - b) / len(b)
                back = e[:, None] * self.w[2] * (1 - h * h)
                grads = [a.T @ back + DECAY * self.w[0], back.sum(axis=0), h.T @ e + DECAY * self.w[2], e.sum(keepdims=True)]
                t += 1
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    self.w[i] = self.w[i] - 0.003 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        z = np.clip(self._logit((x - self.mean) / self.scale) / self.temperature, -500, 500)
        return 1 / (1 + np.exp(-z))


_POOLED = pa.schema([("y", pa.int32()), ("order", pa.int64()), ("x", pa.binary())])


def _pool(shared):
    pooler = []

    def fn(batch: pa.RecordBatch):
        if not pooler:
            pooler.append(Pooler(*shared.value))
        x = pooler[0](batch.column("text"))
        return {"y": batch.column("y"), "order": batch.column("order"), "x": pa.array([r.tobytes() for r in x], pa.binary())}

    return arrow_map(fn, _POOLED)


def fit(docs: DataFrame, labels: DataFrame, folds: int) -> tuple[Pooler, Network]:
    words = word_vectors(docs.select("text"))
    labels = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("int").alias("y"))
    labels = labels.where("doc_id is not null and y in (0, 1)").where(crc_bucket(F.col("doc_id"), folds) != 0)
    chosen = labels.distinct().withColumn("order", F.xxhash64("doc_id", "y")).orderBy("order").limit(SAMPLE)
    rows = docs.join(F.broadcast(chosen), "doc_id").select("text", "y", "order")  # at most SAMPLE rows of three numbers
    shared = docs.sparkSession.sparkContext.broadcast(words)
    rows = rows.mapInArrow(_pool(shared), "y int, order long, x binary").orderBy("order", "x").limit(SAMPLE).collect()
    x = np.array([np.frombuffer(r["x"], dtype=np.float32) for r in rows], dtype=np.float64)
    y = np.array([r["y"] for r in rows], dtype=np.float64)
    return Pooler(*words), Network(x, y)


_SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def _score(shared):
    def fn(batch: pa.RecordBatch):
        pooler, network = shared.value
        return {"doc_id": batch.column("doc_id"), "score": network.probability(pooler(batch.column("text")).astype(np.float64))}

    return arrow_map(fn, _SCORED)


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5,
                  threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per document; learns from labels outside fold 0 of crc32(id) modulo ``folds``."""
    docs = doc_columns(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, folds))
    return docs.mapInArrow(_score(shared), "doc_id long, score double").select(
        "doc_id", (crc_bucket(F.col("doc_id"), folds) == 0).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def _good(shared, text_col: str, threshold: float):
    def run(batches):
        pooler, network = shared.value
        for batch in byte_slices(batches, text_col):
            score = network.probability(pooler(batch.column(text_col)).astype(np.float64))
            yield batch.filter(pa.array(score >= threshold))

    return run


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5,
              threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` the classifier accepts, all columns kept, nothing shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(doc_columns(docs, id_col, text_col), labels, folds))
    return docs.mapInArrow(_good(shared, text_col, threshold), docs.schema)
