"""Lexical search, token counts and the Merkle manifest against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from veracity.llm import lexical
from veracity.llm import queries as Q
from veracity.llm.columns import crc_bucket
from veracity.llm.lexical import search
from veracity.llm.merkle import GROUP, Parent, climb, dataset_manifest
from veracity.llm.token_counts import Counter, count_tokens, read_pieces

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, item long, term string, rank string, score string, tree string, "
        "pos string, n string, digest string, leaf string, root string")
EXTRA = ("x",) * 10
PIECES = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)] + ["The", "of", "É", "naïve", "a-b", "x_y", "\x7f", "\x01z", "漢字"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    texts = [None, "", " \n ", "...", "one", say(20000), "same words here"] + ["same words here"] * 40 + [say(rng.randrange(1, 200)) for _ in range(400)]
    table = [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t or ""), i, *EXTRA[1:]) for i, t in enumerate(texts)]
    return table + [table[9], table[9], (None, "same words here", None, None, None, None, *EXTRA[1:]), (None, None, None, "-", 0, 1, *EXTRA[1:])]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


def test_empty_tables(spark):
    empty, items = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert search(empty, items).count() == 0 and search(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), items.limit(0)).count() == 0
    assert count_tokens(empty, Q.vocabulary_path(PIECES)).count() == 0
    assert dataset_manifest(empty, ["doc_id", "text"]).count() == 0


def terms_of(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded)


def ranking(rows, items, k):
    bags = [(r[0], collections.Counter(terms_of(r[1]))) for r in rows]
    df = collections.Counter(t for _, bag in bags for t in bag)
    n, total = sum(bool(bag) for _, bag in bags), sum(sum(bag.values()) for _, bag in bags)
    want = []
    for item, text in items:
        scored = []
        for d, bag in bags:
            m = 10 + 90 * sum(bag.values()) * n // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
                        for t in set(terms_of(text)))
            if score > 0:
                scored.append((-score, d is None, d))
        want += [(item, rank, d, -s) for rank, (s, _, d) in enumerate(sorted(scored)[:k], 1)]
    return collections.Counter(want)


@pytest.mark.parametrize("segment,block", [(1 << 23, 1_000_000), (2000, 200)])
def test_lexical_search(spark, docs, rows, segment, block):
    rng = random.Random(1)
    items = [(i, " ".join(rng.choice((r[1] or "none").split() or ["none"]) for r in rng.sample(rows, 12))) for i in range(25)]
    items += [(1, "same Words here"), (1, "same words here same"), (None, "THE w1, w2"), (50, None), (51, ""), (52, "..."), (53, "unheard"), (54, "here")]
    table = spark.createDataFrame([(*r, 0, 0) for r in items], "item_id long, text string, item int, rank int")
    got = search(docs, table, segment_bytes=segment, block_terms=block).collect()
    assert collections.Counter((r.item_id, r.rank, r.doc_id, r.score) for r in got) == ranking(rows, items, 10)
    assert sum(r.item_id == 54 for r in got) == 10 and not any(r.item_id in (50, 51, 52, 53) for r in got)


def test_reading_stops_early():
    import numpy as np

    n = 20_000
    rare, common = np.arange(5), np.arange(n)
    lists = lexical.Lists(np.concatenate([rare, common]), np.repeat([0, 1], [5, n]),
                          np.concatenate([np.full(5, 10_000), 1 + common % 7]), np.arange(n), 2)
    ids, scores = lists.search(np.array([0, 1]), 5, 0)
    assert ids.tolist() == [4, 3, 2, 1, 0] and scores.tolist() == [10_005, 10_004, 10_003, 10_002, 10_001]
    assert len(lists.search(np.array([0, 1]), 5, 10_009)[0]) == 0  # nothing can reach what earlier segments hold


def test_counter_matches_the_library():
    import pyarrow as pa
    import sentencepiece

    path, rng = Q.vocabulary_path(PIECES), random.Random(2)
    library, counter = sentencepiece.SentencePieceProcessor(model_file=path), Counter(read_pieces(path)[1])
    alphabet = [*" \n\t\r ab'sreL9١é漢🙂‍\x1c\x85\xa0　.,%;", "▁", "<s>", "</s>", "<unk>", "<0x41>", "   ", "    ", "the", "ing", "  \n", "){", "\x00", "//"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(4000)] + ["", None, "a" * 5000, " " * 3000, "é漢" * 2000]
    n_bytes, tokens = counter.count(pa.array(texts, pa.string()))
    assert tokens.tolist() == [len(library.encode(t or "")) for t in texts]
    assert n_bytes.tolist() == [len((t or "").encode()) for t in texts]


def test_token_counts(docs, rows):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=Q.vocabulary_path(PIECES))
    got = count_tokens(docs, Q.vocabulary_path(PIECES), limit=50).collect()
    size = lambda t: len(library.encode(t or ""))
    assert collections.Counter(map(tuple, got)) == collections.Counter((r[0], len((r[1] or "").encode()), size(r[1]), size(r[1]) > 50) for r in rows)


def test_other_vocabularies_are_refused():
    with pytest.raises(Exception):
        read_pieces(Q.vocabulary_path())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def manifest(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    fold = lambda t: None if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    leaf = lambda r, text: sha("".join(map(field, (r[0], r[3], r[2], r[4], text))))
    sources = collections.defaultdict(list)
    for r in rows:
        sources[r[3]].append(((r[0] is not None, r[0] or 0, leaf(r, r[1])), r))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([k[2] for k, _ in sorted(sources[s], key=lambda x: x[0])]) for s in names}
    top = levels_of([trees[s][-1][0] for s in names])
    root, want = top[-1][0], collections.Counter()
    for i, s in enumerate(names):
        for at, (key, r) in enumerate(sorted(sources[s], key=lambda x: x[0])):
            edited = zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 == 0
            value, proof = leaf(r, fold(r[1])) if edited else key[2], ""
            for place, levels in ((at, trees[s]), (i, top)):
                for nodes in levels[:-1]:
                    run = nodes[place // 16 * 16:place // 16 * 16 + 16]
                    slot = place % 16
                    proof += "".join(run[:slot] + run[slot + 1:])
                    value = sha("".join(run[:slot] + [value] + run[slot + 1:]))
                    place //= 16
            want[r[0], key[2], trees[s][-1][0], root, sha(proof), value, value == root, edited] += 1
    return want


def check_manifest(df, rows):
    docs = df.alias("d")
    got = dataset_manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"],
                           {"text": F.translate(docs["text"], Q._UPPER, Q._LOWER)}, crc_bucket(docs["doc_id"], 5) == 0)
    assert collections.Counter(map(tuple, got.collect())) == manifest(rows)


def test_manifest(docs, rows):
    check_manifest(docs, rows)


def test_manifest_of_a_hot_source(spark):
    rows = [(i, "T" if i % 3 else None, None, "hot", i) for i in range(GROUP + 300)] + [(7, "Again", "en", "hot", 7)] * 40
    rows += [(i, f"Text {i}", "é", f"source {i % 37}", None) for i in range(400)] + [(10**12, "Only", "en", "lone", 1)]
    check_manifest(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(6), rows)


def test_retained_states():
    kids = [sha(str(i)).encode() for i in range(11)]
    parent, new = Parent(kids), sha("new").encode()
    assert parent.digest.decode() == sha(b"".join(kids).decode())
    for slot in range(11):
        assert parent.fold(slot, new) == Parent(kids[:slot] + [new] + kids[slot + 1:]).digest
    assert climb(kids, 1) == [] and len(climb(kids[:1], 17)) == 2  # the last run of a larger tree goes up alone
