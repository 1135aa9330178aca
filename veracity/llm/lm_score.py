"""LM scoring: a class-factored log-bilinear model trained with noise-contrastive estimation.

``P(word | context) = P(class | context) * (c(word) + 0.1) / Z(class)``.  The
``HEAD`` most frequent words are classes of their own; every other word, seen
or not, belongs to the class of its last two bytes; the end of a text is a
class.  ``Z`` sums ``c + 0.1`` over the seen words of a class plus 0.1 for an
unseen one, so probabilities sum to 1 over the vocabulary and one unseen word
per class.

* **Log-bilinear.** The ``CONTEXT`` preceding class vectors, each weighted by
  its position, add up to a predicted vector; a class scores its inner product
  with it plus a bias.
* **Training.** Every position of every training text is trained on: each of the
  ``ROUNDS`` takes one in ``ROUNDS``, the next round the next.  Each task takes numpy steps on
  noise-contrastive estimation (noise: class frequencies, shared by a batch);
  the tasks' parameters are averaged in two levels, ``ROUNDS`` times.  The
  model has a fixed size whatever the corpus.
* **Scoring.** Batched matrix products over all classes give exactly
  normalised log-probabilities of every token of every text; a task works out
  the normaliser of a context once.

Counts come from all training texts.  The ``TOP`` most frequent words (a fixed
number) go to every task; the rest meet their counts in a join on the 64-bit
word hash, pre-aggregated per document, so no hot word is shuffled.

Defined cases: a null text is empty (one end token); a null id counts as the
empty text in the fold; repeated rows are scored separately; no training text
gives base 0 and a uniform model; extra columns are ignored.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.llm.columns import crc_bucket, doc_columns
from veracity.llm.words import Docs, HashIndex, arrow_map, byte_slices
from veracity.session import materialize

TOP, HEAD, SUFFIXES = 65_536, 192, 62
CONTEXT, DIM, ROUNDS, BATCH, NOISE = 3, 16, 2, 512, 96
RATE, AVERAGERS, FLUSH_WORDS = 0.15, 32, 4_000_000
END, OTHER = HEAD + SUFFIXES + 1, HEAD + SUFFIXES
CLASSES = HEAD + SUFFIXES + 2


def _suffix(docs: Docs) -> np.ndarray:
    """The last two bytes of each word (one for a one-byte word) as a 16-bit code."""
    last = docs.data[docs.ends - 1].astype(np.int32)
    prev = docs.data[np.maximum(docs.ends - 2, 0)].astype(np.int32)
    return last | np.where(docs.ends - docs.starts > 1, prev, 0) << 8


_COUNTS_ARROW = pa.schema([("word", pa.int64()), ("c", pa.int64()), ("suffix", pa.int32())])


def _count_words(batches):
    """Partial counts per task, flushed at a bounded number of words."""

    def flush(words, codes):
        words, codes = np.concatenate(words), np.concatenate(codes)
        order = np.argsort(words)  # any occurrence tells a word's suffix
        words, new = words[order], np.ones(len(words), dtype=bool)
        np.not_equal(words[1:], words[:-1], out=new[1:])
        at = np.flatnonzero(new)
        return pa.RecordBatch.from_arrays([pa.array(words[at].view(np.int64)), pa.array(np.diff(np.append(at, len(words)))),
                                           pa.array(codes[order[at]])], schema=_COUNTS_ARROW)

    words, codes, held = [], [], 0
    for part in byte_slices(batches):
        docs = Docs(part.column("text"), lower=True)
        words.append(docs.hashes())
        codes.append(_suffix(docs))
        held += len(words[-1])
        if held >= FLUSH_WORDS:
            yield flush(words, codes)
            words, codes, held = [], [], 0
    if held:
        yield flush(words, codes)


class Vocabulary:
    """The fixed-size part every task holds: top words with counts, suffix classes, class masses."""

    def __init__(self, top: list, suffix_mass: list, n_train: int, distinct: int, tokens: int):
        words = np.array([r["word"] for r in top], dtype=np.int64).view(np.uint64)
        order = np.argsort(words)
        self.place = HashIndex(words)
        self.counts = np.array([r["c"] for r in top], dtype=np.int64)[order]  # in the order of the index
        rank, codes = np.arange(len(top))[order], np.array([r["suffix"] for r in top], dtype=np.int64)[order]
        mass, kinds = np.zeros(1 << 16), np.zeros(1 << 16)
        for r in suffix_mass:
            mass[r["suffix"]], kinds[r["suffix"]] = r["c"], r["kinds"]
        head = rank < HEAD
        np.add.at(mass, codes[head], -self.counts[head])
        np.add.at(kinds, codes[head], -1)
        self.by_suffix = np.full(1 << 16, OTHER, dtype=np.int64)
        best = np.argsort(-mass, kind="stable")[:SUFFIXES]
        self.by_suffix[best] = HEAD + np.arange(len(best))
        self.classes = np.where(head, rank, self.by_suffix[codes])
        self.end_count, self.distinct, self.tokens = n_train, distinct, tokens
        seen = np.zeros(CLASSES)
        seen[rank[head]] = self.counts[head]
        np.add.at(seen, self.by_suffix, mass)
        seen[END] = n_train
        z = seen.copy()
        z[rank[head]] += 0.1
        np.add.at(z, self.by_suffix, 0.1 * kinds)
        z[HEAD:OTHER + 1] += 0.1  # one unseen word in each suffix class
        z[END] += 0.1
        self.counts, self.classes = np.append(self.counts, -1), np.append(self.classes, -1)  # the last stands for other words
        self.log_z = np.log10(np.maximum(z, 0.1))
        self.noise = (seen + 0.5) / (seen + 0.5).sum()

    def look_up(self, docs: Docs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word hashes, counts (-1 beyond the top words) and classes."""
        hashes = docs.hashes()
        at = self.place(hashes)
        classes = self.classes[at]
        return hashes.view(np.int64), self.counts[at], np.where(classes < 0, self.by_suffix[_suffix(docs)], classes)


def _with_ends(docs: Docs, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class sequence with an end after each text, and each token's place in its text."""
    n = docs.n_words + 1
    tokens = np.full(int(n.sum()), END, dtype=np.int64)
    word = np.ones(len(tokens), dtype=bool)
    word[np.cumsum(n) - 1] = False
    tokens[word] = classes
    return tokens, np.arange(len(tokens)) - np.repeat(np.cumsum(n) - n, n)


def _contexts(tokens: np.ndarray, place: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Preceding classes of the tokens ``at``; before a text there are ends."""
    back = np.arange(1, CONTEXT + 1)
    return np.where(place[at][:, None] >= back, tokens[np.maximum(at[:, None] - back, 0)], END)


def _by_class(classes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of the rows of each class."""
    order = np.argsort(classes.astype(np.uint8 if CLASSES <= 256 else np.uint16), kind="stable")
    sorted_ = classes[order]
    new = np.ones(len(order), dtype=bool)
    np.not_equal(sorted_[1:], sorted_[:-1], out=new[1:])
    head = np.flatnonzero(new)
    out = np.zeros((CLASSES, rows.shape[1]), dtype=np.float32)
    out[sorted_[head]] = np.add.reduceat(rows.take(order, axis=0), head, axis=0)
    return out


def _predicted(weighted: list[np.ndarray], ctx: np.ndarray) -> np.ndarray:
    h = weighted[0].take(ctx[:, 0], axis=0)
    for i in range(1, CONTEXT):
        h += weighted[i].take(ctx[:, i], axis=0)
    return h


class LogBilinear:
    def __init__(self, noise: np.ndarray):
        rng = np.random.default_rng(11)
        self.context = rng.normal(0, 0.3, (CLASSES, DIM)).astype(np.float32)
        self.target = rng.normal(0, 0.3, (CLASSES, DIM)).astype(np.float32)
        self.position = np.full((CONTEXT, DIM), 1.0 / CONTEXT, dtype=np.float32)
        self.bias = np.log(noise).astype(np.float32)
        self.noise = noise

    NAMES = ("context", "target", "position", "bias")

    def log10_probs(self, ctx: np.ndarray, tokens: np.ndarray, totals: np.ndarray | None = None, block: int = 2048) -> np.ndarray:
        """``totals`` holds the log of the normaliser of each context met so far, at its classes read as digits (0: not yet)."""
        target, digits = np.ascontiguousarray(self.target.T), CLASSES ** np.arange(CONTEXT)
        weighted = [self.context * p for p in self.position]
        at = ctx @ digits
        totals = np.zeros(CLASSES ** CONTEXT, dtype=np.float32) if totals is None else totals
        fresh = np.unique(at[totals[at] == 0])
        for lo in range(0, len(fresh), block):
            new = fresh[lo:lo + block]
            totals[new] = self._log_totals(_predicted(weighted, new[:, None] // digits % CLASSES), target)
        out = np.empty(len(tokens))
        for lo in range(0, len(tokens), block):
            w = tokens[lo:lo + block]
            own = np.einsum("ij,ij->i", _predicted(weighted, ctx[lo:lo + block]), self.target.take(w, axis=0)) + self.bias[w]
            out[lo:lo + block] = own - totals[at[lo:lo + block]]
        return out / np.log(10)

    def _log_totals(self, h: np.ndarray, target: np.ndarray) -> np.ndarray:
        score, ones = h @ target, np.ones(CLASSES, dtype=np.float32)
        score += self.bias
        longest = float(np.sqrt((h ** 2).sum(axis=1).max() * (target ** 2).sum(axis=0).max()))
        if longest + float(np.abs(self.bias).max()) <= 80:  # neither the exponentials nor their sums leave the range
            return np.log(np.exp(score, out=score) @ ones)
        most = score.max(axis=1)
        score -= most[:, None]
        return most + np.log(np.exp(score, out=score) @ ones)

    def train(self, ctx: np.ndarray, tokens: np.ndarray, state: dict, rng) -> None:
        """One adaptive-gradient step per batch on noise-contrastive estimation."""
        log_noise = np.log(NOISE * self.noise).astype(np.float32)
        below = self.noise.cumsum()
        below /= below[-1]
        for lo in range(0, len(tokens), BATCH):
            c, w = np.ascontiguousarray(ctx[lo:lo + BATCH].T), tokens[lo:lo + BATCH]
            drawn = below.searchsorted(rng.random(NOISE), side="right")  # as rng.choice(CLASSES, NOISE, p=noise) draws
            before = [self.context.take(x, axis=0) for x in c]
            target_w, target_d = self.target.take(w, axis=0), self.target.take(drawn, axis=0)
            h = before[0] * self.position[0]
            for i in range(1, CONTEXT):
                h += before[i] * self.position[i]
            real = (h * target_w).sum(axis=1) + self.bias[w] - log_noise[w]
            fake = h @ target_d.T
            fake += self.bias[drawn]
            fake -= log_noise[drawn]
            e_real = -1 / (1 + np.exp(np.clip(real, -30, 30)))
            e_fake = np.clip(fake, -30, 30, out=fake)
            np.exp(np.negative(e_fake, out=e_fake), out=e_fake)
            e_fake += 1
            np.divide(1, e_fake, out=e_fake)
            size = np.float32(1 / len(w))
            d = e_real[:, None] * target_w
            d += e_fake @ target_d
            g = {"target": _by_class(w, e_real[:, None] * h) + _by_class(drawn, e_fake.T @ h),
                 "bias": (np.bincount(w, e_real, CLASSES) + np.bincount(drawn, e_fake.sum(axis=0), CLASSES)),
                 "context": 0, "position": np.empty_like(self.position)}
            for i in range(CONTEXT):
                g["context"] = g["context"] + _by_class(c[i], d * self.position[i])
                g["position"][i] = np.einsum("ij,ij->j", d, before[i])
            for k, v in g.items():
                v = v * size
                state[k] = state.get(k, 1e-6) + v * v
                getattr(self, k)[...] -= (RATE * v / np.sqrt(state[k])).astype(np.float32)

    def pack(self) -> np.ndarray:
        return np.concatenate([getattr(self, k).ravel() for k in self.NAMES]).astype(np.float64)

    def unpack(self, flat: np.ndarray) -> LogBilinear:
        for k in self.NAMES:
            mine = getattr(self, k)
            mine[...] = flat[:mine.size].reshape(mine.shape)
            flat = flat[mine.size:]
        return self


_PARAMS_ARROW = pa.schema([("part", pa.int32()), ("weight", pa.int64()), ("params", pa.binary())])
_PARAMS = "part int, weight long, params binary"


def _train_task(shared, turn: int):
    def run(batches):
        vocab, model = pickle.loads(shared.value)
        state, rng, steps, seed = {}, np.random.default_rng(5), 0, 0
        held_ctx, held_tok, held = [], [], 0
        for part in byte_slices(batches):
            docs = Docs(part.column("text"), lower=True)
            tokens, place = _with_ends(docs, vocab.look_up(docs)[2])
            seed ^= int(part.column("phase")[0].as_py())
            phase = np.repeat(np.asarray(part.column("phase")), docs.n_words + 1)
            at = np.flatnonzero((place + phase + turn) % ROUNDS == 0)
            held_ctx.append(_contexts(tokens, place, at))
            held_tok.append(tokens[at])
            held += len(at)
            if held >= 1 << 17:
                steps += _steps(model, held_ctx, held_tok, state, rng)
                held_ctx, held_tok, held = [], [], 0
        if held:
            steps += _steps(model, held_ctx, held_tok, state, rng)
        if steps:
            yield pa.RecordBatch.from_arrays(
                [pa.array([seed % AVERAGERS], pa.int32()), pa.array([steps], pa.int64()),
                 pa.array([model.pack().tobytes()], pa.binary())], schema=_PARAMS_ARROW)

    return run


def _steps(model, ctx, tokens, state, rng) -> int:
    ctx, tokens = np.concatenate(ctx), np.concatenate(tokens)
    order = rng.permutation(len(tokens))
    model.train(ctx[order], tokens[order], state, rng)
    return len(tokens)


def _average(batches):
    """Weighted mean of a partition's parameters: one row whatever their number."""
    total, weight, part = 0.0, 0, 0
    for batch in batches:
        for p, w, flat in zip(*(batch.column(i).to_pylist() for i in range(3))):
            total, weight, part = total + w * np.frombuffer(flat), weight + w, p
    if weight:
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([weight], pa.int64()),
                                          pa.array([(total / weight).tobytes()], pa.binary())], schema=_PARAMS_ARROW)


def fit(train: DataFrame) -> tuple[Vocabulary, LogBilinear, DataFrame]:
    """Vocabulary, model and the table of all word counts, from ``(text, phase)``."""
    spark = train.sparkSession
    partial = train.select("text").mapInArrow(_count_words, "word long, c long, suffix int")
    counts = materialize(partial.groupBy("word").agg(F.sum("c").alias("c"), F.min("suffix").alias("suffix")), "lm-counts")
    mass = counts.groupBy("suffix").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("kinds")).collect()  # at most 65,536
    top = counts.orderBy(F.desc("c"), "word").limit(TOP).collect()
    n_train = train.count()
    vocab = Vocabulary(top, mass, n_train, sum(r["kinds"] for r in mass) + (n_train > 0),
                       sum(r["c"] for r in mass) + n_train)
    model = LogBilinear(vocab.noise)
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast(pickle.dumps((vocab, model)))
        tuned = train.mapInArrow(_train_task(shared, turn), _PARAMS).repartition(AVERAGERS, "part").mapInArrow(_average, _PARAMS)
        rows = tuned.collect()  # at most AVERAGERS rows of fixed size
        if rows:
            rows.sort(key=lambda r: (r["part"], r["weight"], bytes(r["params"])))
            weight = sum(r["weight"] for r in rows)
            model.unpack(sum(np.frombuffer(r["params"]) * (r["weight"] / weight) for r in rows))
    return vocab, model, counts


_SCORED = pa.schema([("key", pa.int64()), ("rid", pa.int64()), ("tf", pa.int64()), ("doc_id", pa.int64()),
                     ("n_tokens", pa.int64()), ("known", pa.int64()), ("log_c", pa.float64()), ("lm", pa.float64())])


def _score_task(shared):
    cache = []

    def fn(batch: pa.RecordBatch):
        if not cache:
            # Of a fixed size: one number for each possible context.
            cache.append((*pickle.loads(shared.value), np.zeros(CLASSES ** CONTEXT, dtype=np.float32)))
        vocab, model, totals = cache[0]
        docs = Docs(batch.column("text"), lower=True)
        hashes, counts, classes = vocab.look_up(docs)
        tokens, place = _with_ends(docs, classes)
        rows = batch.num_rows
        owner = np.repeat(np.arange(rows), docs.n_words + 1)
        lm = np.zeros(len(tokens))
        for lo in range(0, len(tokens), 1 << 16):
            at = np.arange(lo, min(lo + (1 << 16), len(tokens)))
            lm[at] = model.log10_probs(_contexts(tokens, place, at), tokens[at], totals)
        lm -= vocab.log_z[tokens]
        word_owner = docs.doc_of_word()
        top = counts >= 0
        log_c = np.bincount(word_owner[top], np.log10(counts[top] + 0.1), rows) + np.log10(vocab.end_count + 0.1)
        known = np.bincount(word_owner[top], minlength=rows) + (vocab.end_count > 0)
        order = np.lexsort((hashes[~top], word_owner[~top]))
        rare, of = hashes[~top][order], word_owner[~top][order]
        head = np.flatnonzero(np.concatenate([[True], (rare[1:] != rare[:-1]) | (of[1:] != of[:-1])])[:len(rare)])
        tf, rare, of = np.diff(np.append(head, len(rare))), rare[head], of[head]
        rid = np.asarray(batch.column("rid"))
        join = lambda x, y: np.concatenate([np.asarray(x), np.asarray(y)])
        zero = np.zeros(len(rare), dtype=np.int64)
        return {
            "key": join(np.asarray(batch.column("spread")), rare), "rid": join(rid, rid[of]), "tf": join(np.zeros(rows, np.int64), tf),
            "doc_id": pa.concat_arrays([batch.column("doc_id"), pa.nulls(len(rare), pa.int64())]),
            "n_tokens": join(docs.n_words + 1, zero), "known": join(known, zero),
            "log_c": join(log_c, zero.astype(float)), "lm": join(np.bincount(owner, lm, rows), zero.astype(float)),
        }

    return arrow_map(fn, _SCORED)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10) -> DataFrame:
    """Scores every text; learns from those whose fold (crc32 of the id, modulo ``folds``) is not 0."""
    docs = doc_columns(docs, id_col, text_col)
    fold = crc_bucket(F.col("doc_id"), folds)
    train = docs.where(fold != 0).select("text", F.pmod(F.xxhash64("text"), F.lit(1 << 20)).alias("phase"))
    vocab, model, counts = fit(train)
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps((vocab, model)))
    rows = docs.withColumn("rid", F.monotonically_increasing_id()).withColumn("spread", F.xxhash64("rid")).mapInArrow(
        _score_task(shared), "key long, rid long, tf long, doc_id long, n_tokens long, known long, log_c double, lm double")
    seen = counts.select(F.col("word").alias("key"), F.col("c").alias("seen"))
    met = rows.join(seen, "key", "left").select(
        "rid", "doc_id", "n_tokens", "lm",
        (F.col("known") + F.when(F.col("seen") > 0, F.col("tf")).otherwise(0)).alias("known"),
        (F.col("log_c") + F.when(F.col("tf") > 0, F.col("tf") * F.log10(F.coalesce("seen", F.lit(0)) + F.lit(0.1)))
         .otherwise(0.0)).alias("log_c"))
    size = float(np.log10(vocab.tokens + 0.1 * (vocab.distinct + 1)))
    total = met.groupBy("rid").agg(F.max("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"),
                                   F.sum("known").alias("n_known"), F.sum("log_c").alias("log_c"), F.sum("lm").alias("lm"))
    return total.select(
        "doc_id", (fold == 0).alias("held_out"), "n_tokens", "n_known",
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("log_c") - F.col("n_tokens") * F.lit(size)).alias("base_score"),
        (F.col("log_c") + F.col("lm")).alias("score"))
