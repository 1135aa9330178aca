"""Operators for training data against brute force, on small tables full of edge cases."""

import collections
import hashlib
import math
import pickle
import random
import re
import types
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from veracity.llm import decontaminate, lm_score
from veracity.llm import queries as Q
from veracity.llm.bpe import Bpe, encode_texts
from veracity.llm.components import connected_components
from veracity.llm.decontaminate import BUCKETS, COSINE, RANK, REWORDED, WINDOW, _common, _search, _words, build_index, drop_leaks, find_leaks
from veracity.llm.jaccard_join import keep_one_of_each, near_duplicates
from veracity.llm.licenses import scan_licenses
from veracity.llm.lm_score import CLASSES, LogBilinear, score_texts
from veracity.llm.nearest import nearest
from veracity.llm.quality import keep_good, score_quality
from veracity.llm.secrets import mask_secrets, scan_secrets
from veracity.llm.sharding import assign_shards, write_shards
from veracity.llm.substring_dedup import remove_repeats
from veracity.session import list_folder, shared_dir

DOCS = "doc_id long, text string, lang string, source string, n_chars long, anchor string, key string, root string, num string"


def lower(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()


def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)] + ["The", "of", "é", "naïve"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, passage = say(120), say(25)
    texts = [None, "", "  \n\t ", "one", "Two words", say(19), say(20), "a " * 60, base, base, base, say(3000)]
    for i in range(60):  # a family of near copies
        words = base.split()
        for _ in range(i % 5):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    texts += [say(30) + " " + passage + " " + say(rng.randrange(40)) for _ in range(25)]
    rows = [(i, t, "en", f"s{i % 4}", len(t or ""), "x", None, "y", "z") for i, t in enumerate(texts)]
    return rows + [rows[8], rows[8], (None, base, None, None, None, "x", "y", None, "z"), (None, None, None, None, 0, "", "", "", "")]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    for df in (remove_repeats(empty), score_texts(empty), assign_shards(empty), encode_texts(empty, Q.vocabulary_path()),
               scan_licenses(empty, F.lit("a/b")), score_quality(empty, labels), nearest(vectors), near_duplicates(empty),
               scan_secrets(empty), find_leaks(empty, bench), keep_one_of_each(empty), drop_leaks(empty, bench),
               mask_secrets(empty), keep_good(empty, labels)):
        assert df.count() == 0


def test_substring_dedup(docs, rows):
    order = sorted({(math.inf if r[0] is None else r[0], r[1] or "") for r in rows})
    first, want = {}, {}
    for d, text in order:
        words = text.encode().split()
        for s in range(len(words) - 19):
            first.setdefault(tuple(words[s:s + 20]), (d, s))
    for d, text in order:
        words = text.encode().split()
        keep = [True] * len(words)
        for s in range(len(words) - 19):
            if first[tuple(words[s:s + 20])] < (d, s):
                keep[s:s + 20] = [False] * 20
        left = b" ".join(w for w, k in zip(words, keep) if k)
        want[None if d == math.inf else d, len(words)] = (keep.count(False), hashlib.sha256(left).hexdigest())
    got = remove_repeats(docs).collect()
    assert len(got) == len(rows)
    assert all(want[r.doc_id, r.n_words] == (r.n_removed, r.kept_sha256) for r in got)
    assert sum(r.n_removed for r in got) > 1000


def test_lm_scoring(docs, rows):
    counts, total = collections.Counter(), 0
    fold = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10
    for r in rows:
        if fold(r[0]):
            counts.update([*lower(r[1]), None])
    total, v = sum(counts.values()), len(counts)
    want = collections.Counter()
    for r in rows:
        tokens = [*lower(r[1]), None]
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (v + 1))) for t in tokens)
        want[r[0], fold(r[0]) == 0, len(tokens), sum(counts[t] > 0 for t in tokens), total, round(base, 6)] += 1
    got = score_texts(docs).collect()
    assert want == collections.Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_lm_is_normalised():
    rng = np.random.default_rng(0)
    model = LogBilinear(np.full(CLASSES, 1 / CLASSES))
    ctx = np.repeat(rng.integers(0, CLASSES, (1, 3)), CLASSES, axis=0)
    assert abs((10 ** model.log10_probs(ctx, np.arange(CLASSES))).sum() - 1) < 1e-4


@pytest.mark.parametrize("limit", [400, 2000, 1 << 20])
def test_sharding(docs, rows, limit, tmp_path):
    got = assign_shards(docs, limit).toPandas()
    assert len(got) == len(rows)
    size = got.groupby("shard").agg(n=("n_bytes", "size"), b=("n_bytes", "sum"), said=("shard_bytes", "max"))
    assert (size.b == size.said).all() and ((size.b <= limit) | (size.n == 1)).all()
    tree = collections.Counter()
    for shard, b in size.b.items():
        bits = shard[1:].split("/")[0]
        for i in range(len(bits) + 1):
            tree[bits[:i]] += b
    assert all(tree[s[1:].split("/")[0][:-1]] > limit for s in size.index if len(s.split("/")[0]) > 1)  # no needless split
    write_shards(docs, f"{tmp_path}/{limit}", limit)
    assert docs.sparkSession.read.parquet(f"{tmp_path}/{limit}").count() == len(rows)


def test_bpe_matches_the_library(docs, rows):
    from tokenizers import Tokenizer

    tokenizer, coder = Tokenizer.from_file(Q.vocabulary_path()), Bpe(open(Q.vocabulary_path()).read())
    rng = random.Random(5)
    alphabet = [*" \n\t ab'sreL9١é漢🙂‍\x1c\x85\xa0　.,%", "<|endoftext|>", "   ", "'ll", "\n\n", "&&&"]
    for text in ["".join(rng.choice(alphabet) for _ in range(rng.randrange(25))) for _ in range(3000)] + [r[1] or "" for r in rows]:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert coder.encode(text).tolist() == ids
        assert coder.decode(ids) == tokenizer.decode(ids, skip_special_tokens=False)
    plain = encode_texts(docs, Q.vocabulary_path()).collect()
    assert len(plain) == len(rows) and collections.Counter(r.decoded for r in plain) == collections.Counter(r[1] or "" for r in rows)


def test_quality_held_out(spark):
    good = [(i, " ".join(f"plain{j % 17} words{(i + j) % 23}" for j in range(20)), 1) for i in range(0, 400, 2)]
    bad = [(i, " ".join(f"ju{j % 7}nk%%% sp{(i * j) % 11}am!!" for j in range(20)), 0) for i in range(1, 400, 2)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in good + bad] + [(1000, None), (None, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in good + bad] + [(None, 1, 0), (7777, 1, 0), (2, None, 0)],
                                   "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in score_quality(docs, labels).collect()}
    assert len(got) == 402 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    held = [(got[i], y) for i, _, y in good + bad if got[i].held_out]
    assert held and sum(r.predicted == y for r, y in held) >= 0.95 * len(held)
    kept = {r.doc_id for r in keep_good(docs, labels).collect()}
    assert kept == {i for i, r in got.items() if r.predicted}


def test_nearest(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 12)).round(2)
    x[200:700] = x[100]  # one very common vector
    odd = [(5001, None), (5002, []), (5003, [0.0] * 12), (5004, [float("nan")] * 12), (5100, [float("inf")] * 12), (None, [1.0] * 12),
           (5005, [1.0] * 3)]
    table = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)] + [(*o, 0) for o in odd],
                                  "vec_id long, embedding array<double>, label int")
    got = collections.defaultdict(list)
    for r in sorted(nearest(table).collect(), key=lambda r: r.rank):
        got[r.query_id].append((r.vec_id, r.score))
    assert sorted(got) == list(range(0, 1500, 100))
    for q, found in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(len(x)), d)) if i != q][:10]
        assert [i for i, _ in found] == order and all(abs(s - d[i]) < 1e-12 for i, s in found)


def components(rows, size, percent):
    sets, heads = [], {}
    for d, text, *_ in rows:
        w = lower(text)
        sets.append((math.inf if d is None else d, frozenset(zip(*(w[i:] for i in range(size)))) if len(w) >= size else frozenset([tuple(w)]) if w else None))
    root = list(range(len(sets)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    for i, (d, _) in enumerate(sets):
        heads[find(i)] = min(heads.get(find(i), math.inf), d)
    fix = lambda d: None if d == math.inf else d
    return collections.Counter((fix(d), len(s or ()), fix(heads[find(i)])) for i, (d, s) in enumerate(sets))


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80)])
def test_jaccard_join(docs, rows, size, percent):
    got = near_duplicates(docs, shingle=size, percent=percent).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == components(rows, size, percent)
    if size == 5:
        kept = keep_one_of_each(docs).collect()
        with_words = [r.component_id for r in got if r.n_shingles]
        assert sorted(r.doc_id for r in kept if lower(r.text)) == sorted(set(with_words))
        assert sum(not lower(r.text) for r in kept) == sum(not lower(r[1]) for r in rows)


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in links:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}


def test_secrets(spark):
    shared, lone = "Zx81bcdeFGHIJ99klmn0", "Qq17rstuVWXYZ55abcd3"
    texts = [(1, f'password = "{lone}"', "o1"), (2, f"again {lone} here", "o1"), (3, f"token: {shared}", "o1"), (4, f"API_KEY={shared}", "o2"),
             (5, f"secret:{shared}", "o3"), (6, f"bare {shared}", "o4"), (7, "AKIA" + "B" * 12 + " AKIASHORT", "o1"), (8, "x" + "0123456789abcdef" * 2, None),
             (9, "secret: token: abcdefghij", "o2"), (10, None, "o2"), (11, "", "o2"), (12, "🙂é passwd=abcdefgh. Token == 'abcdefgh'", "o5"),
             (13, "secret=short", "o1")] + [(20, f"password: {lone}9 end", "o9")] * 2
    docs = spark.createDataFrame([(i, t, "en", o, len(t or ""), "", "", "", "") for i, t, o in texts], DOCS)
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    got = {r.doc_id: r for r in scan_secrets(docs).collect()}
    for i, text, _ in texts:
        spans = []
        for k, (kind, pattern, least) in enumerate((("assign", assign, 8), ("access", r"AKIA[A-Z0-9]+", 16), ("hex", r"[0-9a-f]+", 32))):
            spans += [(m.start(), k, m.end(), kind) for m in re.finditer(pattern, text or "") if len(m[2] if k == 0 else m[0]) >= least]
        said = ",".join(f"{s[3]}:{s[0]}:{s[2]}" for s in sorted(spans))
        assert got[i].base_sha256 == hashlib.sha256(said.encode()).hexdigest(), i
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(s[1] == k for s in spans) for k in range(3))
    assert got[2].spans == f"bare:6:{6 + len(lone)}" and got[6].spans == "" and got[4].n_copied == 1 and got[1].n_live == 1
    masked = {r.doc_id: r.text for r in mask_secrets(docs).collect()}
    assert masked[1] == '[SECRET]"' and masked[2] == "again [SECRET] here" and masked[4] == f"API_KEY={shared}" and masked[10] is None
    assert masked[12] == "🙂é [SECRET] Token == 'abcdefgh'" and mask_secrets(docs).count() == len(texts)


def test_secrets_in_copies(spark):
    rng = random.Random(5)
    say = lambda n: " ".join(f"w{rng.randrange(500)}" for _ in range(n))
    key, near, example, short = "Lk42live0000KEY77abc", "Nk42live0000KEY88abc", "Ex42ample000KEY99abc", "pw4short9"
    one, other = f"{say(40)} password={key} {say(40)}", f"{say(200)} password={near} {say(200)}"
    texts = [(one, f"o{i}") for i in range(3)] + [(f"{other} {i}", f"o{i}") for i in range(3)]
    texts += [(f"{say(20)} token: {example} {say(20)}", f"o{i}") for i in range(3)]
    texts += [(f"see {key} there", "o0"), (f"see {near} there", "o0"), (f"see {example} there", "o0"), (f"secret: {short}", "o1"), (f"has {short} too", "o1")]
    docs = spark.createDataFrame([(i, t, "en", o, len(t), "", "", "", "") for i, (t, o) in enumerate(texts)], DOCS)
    got = {r.doc_id: r for r in scan_secrets(docs).collect()}
    assert [(got[i].n_live, got[i].n_copied) for i in range(9)] == [(1, 0)] * 6 + [(0, 1)] * 3
    assert [got[i].spans for i in (9, 10, 11, 13)] == ["bare:4:24", "bare:4:24", "", "bare:4:13"]
    every = {r.doc_id: r.text for r in mask_secrets(docs, copied=True).collect()}
    assert not any(v in t for t in every.values() for v in (key, near, example, short))
    many = docs.unionByName(spark.createDataFrame([(100 + i, "x", "en", f"p{i}", 1, "", "", "", "") for i in range(30)], DOCS))
    assert all(r.n_copied == 0 for r in scan_secrets(many).collect())  # 3 of 33 owners


def test_secrets_shared_surroundings_are_no_copies(spark):
    rng = random.Random(8)
    say = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    shared, mine = say(30), "Qk77own0000KEY"
    texts = [(f"{say(60)} {shared} password=Ex42ample000KEY99abc {shared[::-1]} {say(60)}", f"o{i}") for i in range(20)]
    base = f"{say(90)} password={mine} {say(90)}"
    texts += [(base.replace(" w1", f" v{i}", 1), f"o{i}") for i in range(20)]  # near copies of one text: one vote
    docs = spark.createDataFrame([(i, t, "en", o, len(t), "", "", "", "") for i, (t, o) in enumerate(texts)], DOCS)
    got = {r.doc_id: (r.n_live, r.n_copied) for r in scan_secrets(docs).collect()}
    assert [got[i] for i in range(40)] == [(0, 1)] * 20 + [(1, 0)] * 20


def test_licenses(spark):
    files = [("a/LICENSE", "Released under the MIT License."), ("a/b/x", "int main;"), ("a/c/y", "Licensed under the Apache License, Version 2.0.\ncode"),
             ("q/z", "nothing"), (None, None), ("a/d/e/f/deep", ""), ("a/b/LICENSE", "This work is licensed under the GNU General Public License, version 3.")]
    table = spark.createDataFrame([(i, t, p) for i, (p, t) in enumerate(files)], "doc_id long, text string, path string")
    got = {r.doc_id: r for r in scan_licenses(table, F.col("path")).collect()}
    assert [(got[i].licence, got[i].origin) for i in range(7)] == [
        ("MIT", "file"), ("GPL-3.0", "inherited"), ("Apache-2.0", "header"), (None, "none"), (None, "none"), ("MIT", "inherited"), ("GPL-3.0", "file")]
    assert got[5].directory == "a" and got[1].directory == "a/b"


def test_decontamination(spark):
    rng = random.Random(9)
    words = [f"word{i}" for i in range(900)] + ["The", "of", "and"] * 60
    say = lambda n: [rng.choice(words) for _ in range(n)]
    items = [say(rng.randrange(16, 55)) for _ in range(40)]
    bench = spark.createDataFrame([(i, " ".join(w) + ".") for i, w in enumerate(items)] + [(None, None), (99, ""), (0, " ".join(items[0]) + ".")],
                                  "item_id long, text string")
    texts, leaked = [], {}
    for i, item in enumerate(items):
        edited = [w if rng.random() > 0.12 else "changed" for w in item]
        texts.append((i, " ".join([*say(rng.randrange(90)), *(w.upper() for w in (item if i % 2 else edited)), *say(rng.randrange(90))])))
        leaked[i] = i
    texts += [(100 + i, " ".join(say(rng.randrange(400)))) for i in range(60)] + [(500, None), (501, ""), (None, "x")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, "", "", "", "") for i, t in texts], DOCS)
    found = {(r.doc_id, r.item_id) for r in find_leaks(docs, bench).collect()}
    assert {d for d, _ in found} == set(leaked) and {(d, i) for d, i in leaked.items()} <= found
    assert sorted(str(r.doc_id) for r in drop_leaks(docs, bench).collect()) == sorted(str(i) for i, _ in texts if i not in leaked)


def _bench_of(spark, passages):
    return spark.createDataFrame(list(enumerate(passages)), "item_id long, text string").repartition(4)


def test_lm_trains_on_every_position(monkeypatch):
    vocab = lm_score.Vocabulary([], [], 3, 0, 3)
    shared = types.SimpleNamespace(value=pickle.dumps((vocab, LogBilinear(vocab.noise))))
    texts, met = ["a b c d e f g", "h", "", "i j k l m n o p q r s"], []
    monkeypatch.setattr(lm_score, "_steps", lambda model, ctx, tokens, state, rng: met.extend(np.concatenate(tokens)) or 0)
    batch = pa.RecordBatch.from_pydict({"text": texts, "phase": pa.array([5, 2, 8, 7], pa.int64())})
    for turn in range(lm_score.ROUNDS):
        assert not list(lm_score._train_task(shared, turn)([batch]))
    tokens, _ = lm_score._with_ends(words := lm_score.Docs(pa.array(texts), lower=True), vocab.look_up(words)[2])
    assert sorted(met) == sorted(tokens)


def test_decontamination_beyond_the_rank(spark):
    rng = random.Random(17)
    say = lambda n: [rng.choice(("the", "of", "and")) if rng.random() < 0.3 else f"word{rng.randrange(9000)}" for _ in range(n)]
    passages = [say(rng.randrange(15, 60)) for _ in range(2500)]
    index = build_index(_bench_of(spark, [" ".join(p) for p in passages]))
    exact, pieces = index.sparse, index.latent.shape[1]
    assert pieces == exact.n == 2500 and index.basis.shape[1] == RANK
    texts = [" ".join([*say(25), *p, *say(25)]) for p in passages[:600]]
    found = {(d, i) for d, i, *_ in _search(index, _words(pa.array(texts)))}
    assert all((i, i) in found for i in range(600))
    term, w = windows = np.random.default_rng(1).integers(0, BUCKETS, (40, WINDOW)), np.ones((40, WINDOW))
    term[:, :20] = [[exact.cell[k] % BUCKETS for k in np.random.default_rng(j).integers(0, len(exact.cell), 20)] for j in range(40)]
    dense = np.zeros((exact.n, BUCKETS))
    dense[exact.cell // BUCKETS, exact.cell % BUCKETS] = exact.value
    norm = np.sqrt(np.einsum("ij,ijk,ik->i", w, term[:, :, None] == term[:, None, :], w))
    brute = np.array([dense[:, t].sum(axis=1) for t in term]) / norm[:, None]
    near = {(i, int(j)): c for i, j, c in exact.near(*windows, norm)}
    assert near.keys() == {(int(i), int(j)) for i, j in zip(*np.nonzero(brute >= COSINE))}


def topics(rng, n_topics=30, each=8):
    """Passages whose topic has a vocabulary of its own, each with an answer of its own."""
    words = [[f"t{t}w{i}" for i in range(14)] for t in range(n_topics)]
    out = []
    for t in range(n_topics):
        for k in range(each):
            out.append((t, [rng.choice(words[t]) for _ in range(26)], [f"answer{t}x{k}", "is", f"value{k}y{t}", "here"]))
    return words, out


def test_decontamination_finds_paraphrases(spark, monkeypatch):
    rng = random.Random(31)
    words, passages = topics(rng)
    bench = spark.createDataFrame([(i, " ".join(p) + ". " + " ".join(a) + ".") for i, (_, p, a) in enumerate(passages)], "item_id long, text string")
    index, texts = build_index(bench), []
    for t, passage, answer in passages:  # reordered, half of the words replaced by others of the topic
        mixed = [w if rng.random() < 0.5 else rng.choice(words[t]) for w in passage]
        rng.shuffle(mixed)
        texts.append([f"pad{rng.randrange(999)}" for _ in range(40)] + mixed + answer + [f"pad{rng.randrange(999)}" for _ in range(40)])
    clean = [[f"pad{rng.randrange(999)}" for _ in range(60)] + rng.choices(words[t % 30], k=20) for t in range(60)]
    assert index.basis.shape[1] < len(passages) // 2
    shares = [_common(index.words[i], _words(pa.array([" ".join(x)])).hashes().tolist()) / len(index.words[i]) for i, x in enumerate(texts)]
    reworded = {i for i, s in enumerate(shares) if s < 0.5}
    assert len(reworded) > 120
    docs = _words(pa.array([" ".join(x) for x in texts + clean]))
    found = {(d, i) for d, i, *_ in _search(index, docs)}
    assert all(d == i for d, i in found)
    able = {i for i in reworded if shares[i] >= REWORDED}
    assert len(able) > 100 and len({d for d, _ in found} & able) >= 0.9 * len(able)
    monkeypatch.setattr(decontaminate, "MEANING", 2.0)  # without the latent space they are lost
    assert not {d for d, *_ in _search(index, docs)} & reworded


def test_decontamination_of_long_passages_and_texts(spark):
    rng = random.Random(41)
    say = lambda n, k="w": [f"{k}{rng.randrange(3000)}" for _ in range(n)]
    passages = [say(1500), say(97), say(40), say(15)]
    index = build_index(_bench_of(spark, [" ".join(p) for p in passages]))
    assert [int(x) for x in np.bincount(index.passage)] == [16, 1, 1, 1]
    texts = [" ".join([*say(9000, "x"), *p, *say(9000, "x")]) for p in passages] + [" ".join(say(20000)), "", None]
    found = _search(index, _words(pa.array(texts)))
    assert sorted((d, i) for d, i, *_ in found if d != 4) == [(i, i) for i in range(4)]
    for d, i, _, share, answer in found:
        brute = _lcs(passages[i], texts[d].split())
        assert share * len(passages[i]) <= brute and answer <= 1
    repeated = spark.createDataFrame([(1, texts[2], "k", 0)] * 3 + [(2, "clean", None, 1)], "doc_id long, text string, part string, rows long")
    assert [(r.doc_id, r.item_id) for r in find_leaks(repeated, _bench_of(spark, [" ".join(p) for p in passages])).collect()] == [(1, 2)]
    assert [r.doc_id for r in drop_leaks(repeated, _bench_of(spark, [" ".join(p) for p in passages])).collect()] == [2]


def _lcs(a, b):
    row = [0] * (len(a) + 1)
    for w in b:
        if w in a:
            new = [0]
            for i, x in enumerate(a):
                new.append(row[i] + 1 if x == w else max(row[i + 1], new[i]))
            row = new
    return row[-1]


def test_queries_and_pipeline(spark):
    import __spark_entry__ as E
    import corpus_pipeline as P

    sf = "/root/testdata/sf0.001"
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in Q.QUERIES} and set(Q.QUERIES) <= set(E.queries())
    assert 4 <= len(P.STAGES) <= 5 and E.queries()["pipeline"] is P.run
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = lambda: {x for x in list_folder(spark, shared_dir(spark)) if x.startswith("veracity-")}
    earlier = kept()
    out, at = P.run(spark, sf), docs
    assert [x.split("-")[:3] for x in kept() - earlier] == [["veracity", "pipeline", "secrets"]]  # what the lazy last stage reads
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    for name, stage in P.STAGES[:-1]:
        at = stage(spark, at, sf)
        assert at.columns == docs.columns, name
    assert 0 < out.count() <= docs.count()
