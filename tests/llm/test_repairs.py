"""Whole results where cells are uneven, tables are cut differently, and columns clash."""

import collections
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from veracity.llm import queries as Q
from veracity.llm.bpe import KEPT_BYTES, Bpe
from veracity.llm.jaccard_join import keep_one_of_each
from veracity.llm.licenses import TEXTS, scan_licenses
from veracity.llm.nearest import nearest
from veracity.llm.quality import score_quality
from veracity.llm.secrets import mask_secrets
from veracity.llm.words import top_words


def test_nearest_over_many_uneven_cells(spark):
    """A third of 9,000 vectors equal, two thirds of the queries far from all others: ten rows each, nearly all of them the nearest."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(9000, 16))
    x[np.arange(9000) % 3 == 1] = x[1]
    asked = np.arange(0, 9000, 100)
    x[asked[:60]] *= 40
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(5)
    got = collections.defaultdict(set)
    rows = nearest(table).collect()
    for r in rows:
        got[r.query_id].add(r.vec_id)
    assert sorted(got) == asked.tolist() and all(len(v) == 10 for v in got.values())
    assert collections.Counter(r["rank"] for r in rows) == {i: 90 for i in range(1, 11)}
    hits = 0
    for q in asked:
        d = ((x - x[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        limit = np.sort(d)[9]
        hits += sum(d[i] <= limit + 1e-9 for i in got[q])
    assert hits >= 0.9 * 900


def test_nearest_of_a_repeated_query_id(spark):
    rows = [(100, [1.0, 1.0]), (100, [5.0, 5.0]), (1, [1.1, 1.0]), (2, [5.0, 5.1]), (3, [9.0, 9.0])]
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == [(100, 1, 1), (100, 2, 2), (100, 3, 3)]


def test_quality_does_not_depend_on_partitions(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    good = [(i, " ".join(rng.choice(words[:1500]) for _ in range(40)), 1) for i in range(0, 600, 2)]
    bad = [(i, " ".join(rng.choice(words[1000:]) + "!!" * (i % 3) for _ in range(40)), 0) for i in range(1, 600, 2)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in good + bad], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in good + bad], "doc_id long, quality int, toxic int")
    few, many = ({r.doc_id: r.score for r in score_quality(docs.repartition(n, "doc_id"), labels).collect()} for n in (2, 24))
    assert few.keys() == many.keys() and max(abs(few[i] - many[i]) for i in few) < 1e-6


def test_top_words_are_counted_over_all_texts(spark):
    texts = ["a b c d e", "a B", "b f g", None, "", "c f a"] * 7
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    want = sorted(collections.Counter(w for t in texts for w in (t or "").lower().split()).values(), reverse=True)[:4]
    for parts in (1, 9):
        assert sorted(top_words(docs.repartition(parts), 4)[1].tolist(), reverse=True) == want


def test_clashing_columns(spark):
    extra = ["own_ord", "own_th", "own_rows", "own_stays", "own_maybe", "stays", "rows", "bloom_word", "bloom_bits", "mask_spans", "mask_key", "head"]
    text = "one two three four five six seven eight nine ten eleven password=Secret123abc"
    rows = [(i, t, "en", "s", 1) for i, t in enumerate([text, text, None, "", "other words entirely"])] + [(0, text, "en", "s", 1)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    odd = plain.withColumns({c: F.lit(i) for i, c in enumerate(extra)})
    for change in (keep_one_of_each, lambda d: mask_secrets(d, copied=True)):
        want, got = change(plain), change(odd)
        assert got.columns == odd.columns
        assert collections.Counter(map(str, got.select(plain.columns).collect())) == collections.Counter(map(str, want.collect()))
    assert keep_one_of_each(odd).count() == 4


def test_pieces_are_cut_where_pretokens_begin():
    from tokenizers import Tokenizer

    library, coder = Tokenizer.from_file(Q.vocabulary_path()), Bpe(open(Q.vocabulary_path()).read())
    rng = random.Random(6)
    alphabet = [*"   \n\t ab'sreL9١é漢🙂‍\x1c\x85\xa0　    .,%ñ", "'ll", "\n\n", "&&&", "the", " foo", " bar"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(6000)]
    texts += ["", None, " ", "a ", "x" * 3000, "y" * KEPT_BYTES, "z" * (KEPT_BYTES + 1), "ab " * 900, " " * 500, "é漢" * 400]
    for some in (texts, ["x <|endoftext|> y", "<|endoftext|>", None, "a b"], [None, ""], []):
        rows, decoded = coder.encode_all(pa.array(some, pa.string()))
        want = library.encode_batch([t or "" for t in some], add_special_tokens=False)
        assert [r.tolist() for r in rows] == [e.ids for e in want]
        assert decoded == [library.decode(e.ids, skip_special_tokens=False) for e in want]


def test_trees_in_rows_agree_with_one_tree():
    coder = Bpe(open(Q.vocabulary_path()).read())
    rng = random.Random(2)
    raws = [bytes(rng.choice(b" aeinrstlhoundTHE.123\xc3\xa9") for _ in range(rng.randrange(2, KEPT_BYTES + 1))) for _ in range(3000)]
    assert coder.merge_all(raws) == [np.array(coder.merge(r), dtype="<u4").tobytes() for r in raws]


def test_licences_of_any_length_and_place(spark):
    """Whole licence texts, within long texts too; a declaration inside a sentence; licence files by name; nothing where none is."""
    rng = random.Random(4)
    prose = lambda n: " ".join(rng.choice(["alpha", "river", "stone", "cloud", "seven", "table", "and", "of"]) for _ in range(n))
    mit = "MIT License\n\nCopyright (c) 2020 Some One\n\n" + TEXTS["MIT"]
    files = [
        ("p/LICENSE", mit), ("p/src/a", "code"), ("q/LICENSE.txt", "Released under the MIT License. " + prose(500)), ("q/b", None),
        ("r/long.md", prose(2000) + "\n" + TEXTS["BSD-3-Clause"] + "\n" + prose(9000)), ("r/c", ""),
        ("s/d.py", "# This module, written in 2019, is licensed under the Apache License, Version 2.0, like all others\n" + prose(50)),
        ("s/e.py", "nothing"), ("t/f.md", prose(300) + " the copyright of a river " + prose(300)), ("p/src/a", "code"),
        *((f"u/{k}", v) for k, v in TEXTS.items())]
    table = spark.createDataFrame([(i, p, x, "c") for i, (p, x) in enumerate(files)], "doc_id long, path string, text string, words string")
    got = {r.doc_id: (r.licence, r.origin) for r in scan_licenses(table.repartition(3), F.col("path")).collect()}
    assert [got[i] for i in range(10)] == [
        ("MIT", "file"), ("MIT", "inherited"), ("MIT", "header"), ("MIT", "inherited"), ("BSD-3-Clause", "file"),
        ("BSD-3-Clause", "inherited"), ("Apache-2.0", "header"), (None, "none"), (None, "none"), ("MIT", "inherited")]
    assert [got[10 + i] for i in range(len(TEXTS))] == [(k, "file") for k in TEXTS]
