"""What a step moves or computes, where a limit on disk, memory or time hangs on it."""

import collections
import gc
import tracemalloc
import types

import numpy as np
import pyarrow as pa
import pytest

from veracity.llm import bpe as B
from veracity.llm import jaccard_join as J
from veracity.llm import lm_score as L
from veracity.llm import queries as Q
from veracity.llm import words as W


def test_recount_after_reordering_shuffles_counts_only(spark, monkeypatch):
    """Thirty near copies share frequent shingles: the recount meets every holder, with no exchange but that of its counts."""
    base = [f"common{i}" for i in range(60)]
    texts = [" ".join([*base[:i + 10], f"own{i}", *base[i + 11:]]) for i in range(30)]
    texts += [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(20)]
    texts += [" ".join([f"w0x{j}" for j in range(39)] + ["end"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    exchanges, held, kept = [], [], J.materialize

    def spy(df, label="table", path=None):
        if label == "shared-tokens":
            exchanges.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange "))
        table = kept(df, label, path)
        if label == "shared-postings":
            held.append(table.collect())
        return table

    monkeypatch.setattr(J, "materialize", spy)
    got = {r.doc_id: r.component_id for r in J.near_duplicates(docs).collect()}
    assert got == {i: 0 if i < 30 else 30 if i == 50 else i for i in range(51)}
    assert exchanges == [1, 1]
    for rows in held:
        holders = collections.Counter(r.token for r in rows)
        assert all(r.held == holders[r.token] > 1 for r in rows)
        assert len(rows) == len({(r.num, r.token) for r in rows})


def test_normaliser_of_a_context_is_worked_out_once(monkeypatch):
    """Also where scores are so large or so unlike that exponentials leave the range, probabilities of each context sum to 1."""
    for scale in (1, 200):
        model = L.LogBilinear(np.full(L.CLASSES, 1 / L.CLASSES))
        model.bias[::7] += 10 * scale
        model.context[:9] *= scale
        ctx = np.repeat(np.random.default_rng(2).integers(0, L.CLASSES, (50, L.CONTEXT)), L.CLASSES, axis=0)
        ctx[:9 * L.CLASSES] = np.repeat(np.arange(9), L.CLASSES)[:, None]
        tokens, totals, worked = np.tile(np.arange(L.CLASSES), 50), np.zeros(L.CLASSES ** L.CONTEXT, dtype=np.float32), []
        plain = L.LogBilinear._log_totals
        monkeypatch.setattr(L.LogBilinear, "_log_totals", lambda self, h, t: worked.append(len(h)) or plain(self, h, t))
        first, again = (model.log10_probs(ctx, tokens, totals) for _ in range(2))
        monkeypatch.undo()
        assert sum(worked) == len(np.unique(ctx, axis=0)) and (first == again).all()
        sums = (10 ** first).reshape(50, L.CLASSES).sum(axis=1)
        assert np.abs(sums - 1).max() < 0.01


def test_training_draws_and_steps_as_plain_numpy_does():
    rng = np.random.default_rng(4)
    noise = rng.random(L.CLASSES) + 0.01
    noise /= noise.sum()
    ctx, tokens = rng.integers(0, L.CLASSES, (700, L.CONTEXT)), rng.integers(0, L.CLASSES, 700)
    model, plain = L.LogBilinear(noise), L.LogBilinear(noise)
    model.train(ctx[:L.BATCH], tokens[:L.BATCH], {}, np.random.default_rng(5))
    c, w, drawn = ctx[:L.BATCH], tokens[:L.BATCH], np.random.default_rng(5).choice(L.CLASSES, L.NOISE, p=noise)
    h = sum(plain.context[c[:, i]] * plain.position[i] for i in range(L.CONTEXT))
    log_noise = np.log(L.NOISE * noise).astype(np.float32)
    real = (h * plain.target[w]).sum(axis=1) + plain.bias[w] - log_noise[w]
    fake = h @ plain.target[drawn].T + plain.bias[drawn] - log_noise[drawn]
    v = (np.bincount(w, -1 / (1 + np.exp(real)), L.CLASSES) + np.bincount(drawn, (1 / (1 + np.exp(-fake))).sum(axis=0), L.CLASSES)) / len(w)
    assert np.allclose(model.bias, plain.bias - L.RATE * v / np.sqrt(1e-6 + v * v), atol=1e-4)


def _coder():
    with open(Q.vocabulary_path(), encoding="utf-8") as f:
        return B.Bpe(f.read())


def test_a_remembered_piece_takes_little_memory():
    """What a task remembers of pieces that are all different stays in flat arrays, and goes with the task."""
    rng, coder = np.random.default_rng(3), _coder()
    words = ["".join(map(chr, w)) for w in rng.integers(97, 123, (40000, 7))]
    coder.encode_all(pa.array(["a " * 35000]))  # powers of the hash stay with the process
    coder.forget()
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        for at in range(0, len(words), 8000):
            coder.encode_all(pa.array([" ".join(words[at:at + 8000])]))
        gc.collect()
        held = tracemalloc.get_traced_memory()[0] - before
        coder.forget()
        gc.collect()
        left = tracemalloc.get_traced_memory()[0] - before
    finally:
        tracemalloc.stop()
    assert held < 80 * len(words) and left < 8 * len(words)


def test_pieces_are_forgotten_and_found_again(monkeypatch):
    """Small tables, filled over and over: ids stay those of texts encoded alone."""
    monkeypatch.setattr(B, "MAX_KEPT", 50)
    rng, coder = np.random.default_rng(4), _coder()
    words = [*"ab", "the", "it's", "don't.", "x" * 70, "é漢", "9,9", *(f"word{i}," for i in range(200))]
    for _ in range(30):
        texts = [" ".join(rng.choice(words, rng.integers(0, 30))) for _ in range(20)]
        rows, decoded = coder.encode_all(pa.array(texts))
        assert [r.tolist() for r in rows] == [coder.encode(t).tolist() for t in texts] and decoded == texts
        assert max(len(coder.kept.new[0]), len(coder.kept.old[0])) <= 50


def test_pieces_of_one_hash_are_told_apart(monkeypatch):
    """With hashes of four bits nearly all pieces collide, in a slice and with those remembered."""
    monkeypatch.setattr(B.RangeHash, "__call__", lambda self, start, end: (self.sums[end] - self.sums[start]) * self.back[start] >> np.uint64(60))
    coder = _coder()
    for texts in (["one two three four", "five six"], ["seven eight nine ten", None, "one six"]):
        rows, decoded = coder.encode_all(pa.array(texts))
        assert [r.tolist() for r in rows] == [coder.encode(t or "").tolist() for t in texts]
        assert decoded == [t or "" for t in texts]


def test_a_task_gives_its_memory_back(monkeypatch):
    """At the end of a task, also of one that fails; the encoder's tables are gone by then."""
    calls, batch, key = [], pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["one two", None]}), "test"
    monkeypatch.setattr(W, "_trim", lambda: lambda pad: calls.append(len(B._CODERS[key].kept.new[0]) if key in B._CODERS else pad))
    schema = pa.schema([("doc_id", pa.int64())])
    assert sum(b.num_rows for b in W.arrow_map(lambda b: {"doc_id": b.column("doc_id")}, schema)(iter([batch]))) == 2
    assert calls == [0]
    with pytest.raises(ZeroDivisionError):
        list(W.arrow_map(lambda b: 1 // 0, schema)(iter([batch])))
    assert calls == [0, 0]
    with open(Q.vocabulary_path(), encoding="utf-8") as f:
        shared = types.SimpleNamespace(value=(key, f.read()))
    assert sum(b.num_rows for b in B._encode(shared, True)(iter([batch]))) == 2
    assert len(calls) > 2 and calls[-1] == 0
    B._CODERS.clear()
