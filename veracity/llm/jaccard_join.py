"""N-gram Jaccard join over a token-group matrix.

Documents link when the Jaccard similarity of their sets of word shingles
reaches the threshold.  Copies with equal sets are one *class* from the start.

* **Groups.** Classes are partitioned into groups of similar sets (one frequent
  prefix token, or equal least shingles under two hashes), dealt into blocks of at most ``BLOCK`` members or ``BLOCK_WORK``
  shingles, so no group is ever held whole.
* **Token-group matrix.** A group stores the union of its members' *prefix*
  tokens.  Two sets over the threshold share a prefix token under any common
  order.  The order puts shingles of rare words first and shingles found in
  many documents last, so few unrelated sets meet; it affects cost only.
* **Bound and open.** A class asks the groups that hold one of its prefix
  tokens.  The union of a group's whole sets is kept as a bitmap, and so is
  each set: bits of the class missing from the union bound their overlap from
  above.  Only groups whose bound reaches the least overlap the threshold
  allows are opened: sets are then built from the texts (of these classes
  alone), the bound is taken exactly, and members are compared exactly.

Only components are asked for, so links inside one known component need no
further proof: groups are settled first, then least members of settled
components are settled block by block, level by level; what remains are
classes asking groups of *other* components, the smaller component asking.
No link between different components can be missed, whatever the skew.

Defined cases: null or empty text has no shingles and links with nothing; a
null id never becomes a component id unless all ids of the component are null;
repeated rows are copies; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracity.functions.columns import fresh_names
from veracity.llm.bloom import maybe_in
from veracity.llm.columns import doc_columns
from veracity.llm.components import connected_components
from veracity.llm.words import NULL_ID, Docs, HashIndex, RangeHash, arrow_map, arrow_rows, lists, mix, segments, top_words
from veracity.session import materialize, scratch_tables

BLOCK, BLOCK_WORK, LEVELS = 256, 1 << 18, 6
FREQUENT, MAX_FREQUENT, REORDERINGS, RANKED_WORDS = 12, 1 << 17, 1, 1 << 16
SALTS = 16  # places in which the size of a much asked block is looked up
BATCH_ROWS = 1000  # rows of one Arrow batch of texts: twice its bytes are held next to the heap
LEAST_WORDS, MOST_WORDS = 4, 1 << 12  # 64-bit words of a bitmap: two bits or more for each shingle in between


def _sorted_within(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Order that sorts each document's run of keys; equal keys keep their order."""
    out, at = np.empty(len(keys), dtype=np.int64), 0
    for n in counts.tolist():
        if n:
            out[at:at + n] = at + np.argsort(keys[at:at + n], kind="stable")
            at += n
    return out


def _sets(docs: Docs, size: int, common=None) -> tuple[np.ndarray, ...]:
    """Distinct shingle hashes per document, ascending, flat; their number per document; how common their words are."""
    n = docs.n_words
    n_sh = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    at = np.repeat(docs.first[:-1], n_sh) + segments(n_sh)
    owner = np.repeat(np.arange(len(n)), n_sh)
    words, end = docs.hashes(0), np.minimum(at + size, docs.first[1:][owner])
    tokens = RangeHash(words, 2)(at, end)
    order = _sorted_within(tokens, n_sh)
    new = np.ones(len(tokens), dtype=bool)
    new[1:] = (tokens[order[1:]] != tokens[order[:-1]]) | (owner[order[1:]] != owner[order[:-1]])
    order = order[new]
    counts = np.bincount(owner[order], minlength=len(n))
    if common is None:
        return tokens[order], counts
    sums = np.concatenate([[0], np.cumsum(common(words))])
    return tokens[order], counts, (sums[end] - sums[at])[order]


class Commonness:
    """How often the words of a shingle occur: a sum of rounded logarithms, 0 for words beyond the top ones."""

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        self.place, self.level = HashIndex(words), np.append(np.round(16 * np.log2(1 + counts)).astype(np.int64), 0)

    def __call__(self, words: np.ndarray) -> np.ndarray:
        return self.level[self.place(words)]


_SIGNED = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("n_shingles", pa.int64()), ("cls", pa.binary()), ("gkey", pa.int64()),
                     ("prefix", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64()))])


def _prefixes(tokens, counts, level, percent: int, frequent: HashIndex, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first tokens of each set in the common order, as many as meet every partner's prefix; and their number."""
    place = np.maximum(level, rank[frequent(tokens)]).astype(np.uint64)
    order = _sorted_within(place << np.uint64(32) | tokens >> np.uint64(32), counts)  # ties: by token, as they stand
    need = np.where(counts > 0, counts - (counts * percent + 99) // 100 + 1, 0)
    return tokens[order][segments(counts) < np.repeat(need, counts)], need


_PREFIX = pa.schema([("num", pa.int64()), ("token", pa.int64())])


def _reordered(size: int, percent: int, shared):
    """Prefix tokens of the given classes under the present order."""

    def fn(batch: pa.RecordBatch):
        frequent, rank, common = shared.value
        tokens, counts, level = _sets(Docs(batch.column("text"), lower=True), size, common)
        wanted = batch.column("cls").to_pylist()
        same = np.array([c == d for c, d in zip(wanted, _digests(tokens, counts))])
        prefix, need = _prefixes(tokens, counts, level, percent, frequent, rank)
        mine = np.repeat(same, need)
        return {"num": np.repeat(np.asarray(batch.column("num")), need)[mine], "token": prefix[mine].view(np.int64)}

    return arrow_map(fn, _PREFIX)


def _untouched(shared):
    """Prefix tokens of the classes whose prefix holds no frequent shingle, in place: these keep their prefix."""

    def run(batches):
        frequent = shared.value[0]
        for batch in batches:
            prefix = batch.column("prefix")
            counts = np.asarray(pc.list_value_length(prefix))
            tokens = np.asarray(prefix.flatten())
            hot = frequent(tokens.view(np.uint64)) < len(frequent.table)
            held = np.bincount(np.repeat(np.arange(len(counts)), counts)[hot], minlength=len(counts))
            stays = np.repeat(held == 0, counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.asarray(batch.column("num")), counts)[stays]), pa.array(tokens[stays])], schema=_PREFIX)

    return run


def _digests(tokens: np.ndarray, counts: np.ndarray) -> list[bytes | None]:
    """128-bit digest of each set; None for an empty one."""
    some = counts > 0
    halves = np.zeros((len(counts), 2), dtype=np.uint64)
    for k in range(2):
        if some.any():
            halves[some, k] = np.add.reduceat(mix(tokens + np.uint64(k + 1)), (np.cumsum(counts) - counts)[some])
    raw = halves.tobytes()
    return [raw[16 * i:16 * i + 16] if s else None for i, s in enumerate(some)]


def _signature(size: int, percent: int, shared):
    def fn(batch: pa.RecordBatch):
        frequent, rank, common = shared.value
        tokens, counts, level = _sets(Docs(batch.column("text"), lower=True), size, common)
        some, owner = counts > 0, np.repeat(np.arange(len(counts)), counts)
        gkey = np.zeros(len(counts), dtype=np.uint64)
        size_class = 1 << np.ceil(np.log2(np.maximum(counts / 32, 1))).astype(np.int64)
        size_class = np.where(some, np.clip(size_class, LEAST_WORDS, MOST_WORDS), 0)
        flags = np.zeros(64 * int(size_class.sum()), dtype=bool)
        if len(tokens):
            starts = (np.cumsum(counts) - counts)[some]
            least = mix(tokens[starts] ^ np.minimum.reduceat(mix(tokens + np.uint64(9)), starts))
            gkey[some] = mix(least + size_class[some].astype(np.uint64))
            spot = (mix(tokens + np.uint64(5)) >> np.uint64(40)).astype(np.int64) & (64 * size_class[owner] - 1)
            flags[64 * (np.cumsum(size_class) - size_class)[owner] + spot] = True
        bits = np.packbits(flags, bitorder="little").view(np.int64)
        prefix, need = _prefixes(tokens, counts, level, percent, frequent, rank)
        return {
            "doc_id": batch.column("doc_id"), "th": batch.column("th"), "n_shingles": counts,
            "cls": pa.array(_digests(tokens, counts), pa.binary()),
            "gkey": gkey.view(np.int64), "prefix": lists(prefix.view(np.int64), need, pa.int64()),
            "bits": lists(bits, size_class, pa.int64()),
        }

    return arrow_map(fn, _SIGNED)


_MEMBERS = pa.schema([("num", pa.int64()), ("gkey", pa.int64()), ("block", pa.int64()), ("blocks", pa.int64()), ("n", pa.int64()),
                      ("tokens", pa.binary())])


def _members(size: int):
    """The whole set of each wanted document, for exact comparison."""

    def fn(batch: pa.RecordBatch):
        tokens, counts = _sets(Docs(batch.column("text"), lower=True), size)
        raw, ends = tokens.tobytes(), np.cumsum(counts) * 8
        wanted = batch.column("cls").to_pylist()
        at = [i for i, (c, d) in enumerate(zip(wanted, _digests(tokens, counts))) if c == d]
        rows = pa.array(at, pa.int64())
        return {name: batch.column(name).take(rows) for name in ("num", "gkey", "block", "blocks")} | {
            "n": counts[at], "tokens": pa.array([raw[ends[i] - 8 * counts[i]:ends[i]] for i in at], pa.binary())}

    return arrow_map(fn, _MEMBERS)


def _unpack(column: pd.Series) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype=np.uint64) for x in column]


class Group:
    """A block of sets with the union of its tokens: bound first, then open."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sizes = np.array([len(s) for s in sets])
        flat = np.concatenate(sets)
        self.union, where = np.unique(flat, return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(where, kind="stable")
        self.holders = owner[order]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(where, minlength=len(self.union)))])
        self.percent = percent

    def partners(self, query: np.ndarray) -> np.ndarray:
        """Members linked with the query set; empty if the union's overlap is already too small."""
        at = np.minimum(np.searchsorted(self.union, query), len(self.union) - 1)
        at = at[self.union[at] == query]
        if 100 * len(at) < self.percent * len(query):  # the bound: no member can reach the threshold
            return np.zeros(0, dtype=np.int64)
        lengths = self.first[at + 1] - self.first[at]
        hits = np.repeat(self.first[at], lengths) + segments(lengths)
        both = np.bincount(self.holders[hits], minlength=len(self.sizes))
        return np.flatnonzero(100 * both >= self.percent * (self.sizes + len(query) - both))


def _settle(percent: int):
    """Components inside one block: each member linked to the least member of its component."""

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("num", ignore_index=True)
        sets = _unpack(pdf["tokens"])
        group, root = Group(sets, percent), np.arange(len(sets))
        for i, s in enumerate(sets):
            linked = np.unique(root[group.partners(s)])
            if len(linked) > 1:
                root[np.isin(root, linked)] = linked[0]
        names = pdf["num"].to_numpy()
        moved = root != np.arange(len(root))
        return pd.DataFrame({"a": names[moved], "b": names[root[moved]]})

    return fn


def _open(percent: int):
    """Links between the classes asking a block and its members of other components."""

    def fn(members: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if members.empty or asking.empty:
            return pd.DataFrame({"a": [], "b": []})
        group = Group(_unpack(members["tokens"]), percent)
        names, roots, out = members["num"].to_numpy(), members["root"].to_numpy(), set()
        for s, root in zip(_unpack(asking["tokens"]), asking["root"]):
            out |= {(root, roots[i]) for i in group.partners(s) if roots[i] != root}
        return pd.DataFrame(list(out), columns=["a", "b"])

    return fn


def _block(name: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(name, F.lit(7)), blocks)


def _blocked(members: DataFrame) -> DataFrame:
    """Adds ``block``: members of a group key are dealt out so that a block stays within its bounds."""
    sizes = members.groupBy("gkey").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("work"))
    blocks = sizes.select("gkey", F.greatest(F.ceil(F.col("members") / (BLOCK // 2)), F.ceil(F.col("work") / BLOCK_WORK))
                          .cast("long").alias("blocks"), "members")
    return members.join(blocks, "gkey").withColumn("block", _block("num", F.col("blocks")))


_LINKS = "a long, b long"


def _texts_of(keyed: DataFrame, classes: DataFrame, *carried: str) -> DataFrame:
    """``text, cls, num`` and the carried columns for the row that stands for each class, once per text.

    Repeated rows are made distinct where the join has put them, before anything is built from the text.
    """
    keys, kept = ["ord", "th"], ["cls", "num", *carried]
    rows = classes.select(*keys, *kept)
    met = maybe_in(keyed, keys, rows).join(rows, keys)
    return met.select(*keys, "text", *kept).distinct().select("text", *kept)


def _whole_sets(keyed: DataFrame, classes: DataFrame, shingle: int) -> DataFrame:
    """``(num, gkey, block, blocks, n, tokens)`` of the given classes."""
    texts = _texts_of(keyed, classes, "gkey", "block", "blocks")
    return materialize(texts.mapInArrow(
        _members(shingle), "num long, gkey long, block long, blocks long, n long, tokens binary"), "shingle-sets")


def _settled(wanted: DataFrame, keyed: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``(num, root)``: blocks of each group first, then their components' least members, until each key fits one block."""
    with scratch_tables() as scratch:
        # Dealt before the sets are built: they then move once, straight to their blocks.
        dealt = standing = _whole_sets(keyed, _blocked(wanted).where("members > 1"), shingle)
        level = 0
        roots = wanted.select("num", F.col("num").alias("root"))
        while True:
            inner = materialize(dealt.select("gkey", "block", "num", "tokens").groupBy("gkey", "block")
                                .applyInPandas(_settle(percent), _LINKS), "group-links")
            up = inner.distinct().select(F.col("a").alias("root"), F.col("b").alias("up"))
            roots = materialize(roots.join(up, "root", "left").select("num", F.coalesce("up", "root").alias("root")), "class-roots")
            split, level = dealt.where("blocks > 1").select("gkey").distinct(), level + 1
            if level >= LEVELS or up.isEmpty() or split.isEmpty():
                return scratch.keep(roots)
            earlier, standing = standing, materialize(
                standing.join(split, "gkey", "left_semi")
                .join(up.select(F.col("root").alias("num")), "num", "left_anti"), "group-pivots")
            scratch.drop(earlier)
            dealt = _blocked(standing.drop("block", "blocks"))


def _dealt(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(asker, gkey, block, part)``: the askers of a block in parts of about ``BLOCK``; and ``(gkey, block, part)``, all parts."""
    load = pairs.groupBy("gkey", "block").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("parts"))
    salted = load.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    spread = pairs.withColumn("salt", F.pmod(F.xxhash64("asker", F.lit(11)), F.lit(SALTS).cast("long")))
    asking = spread.join(salted, ["gkey", "block", "salt"]).select(
        "asker", "gkey", "block", _block("asker", F.col("parts")).alias("part"))
    return asking, load.select("gkey", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))


def _asked(wanted: DataFrame, postings: DataFrame, roots: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Where each class is placed, and ``(asker, gkey, block)``: the groups of other components it must open."""
    sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    placed = materialize(_blocked(wanted).select("num", "gkey", "block", "n").join(roots.join(sizes, "root"), "num"), "group-places")
    at = postings.join(placed, "num")
    mixed = at.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("token")
    at = at.join(mixed, "token", "left_semi")
    matrix = at.groupBy("token", "gkey", "block").agg(
        F.max(F.struct("size", "root")).alias("largest"), F.min("n").alias("least_n"), F.max("n").alias("most_n"))
    ask = at.select("token", F.col("num").alias("asker"), F.struct("size", "root").alias("own"), F.col("n").alias("own_n"))
    pairs = ask.join(matrix, "token").where(  # of two components, the smaller asks
        f"own < largest and 100 * most_n >= {percent} * own_n and 100 * own_n >= {percent} * least_n").select("asker", "gkey", "block").distinct()
    pairs = materialize(pairs, "asking-classes")

    sets = wanted.select("num", "n", "bits")
    held = placed.select("num", "gkey", "block").join(sets.select("num", "bits"), "num")
    words = held.select("gkey", "block", F.posexplode("bits").alias("at", "word")).groupBy("gkey", "block", "at").agg(
        F.bit_or("word").alias("word"))
    unions = words.groupBy("gkey", "block").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]).alias("union_bits"))
    missing = "aggregate(zip_with(bits, union_bits, (x, y) -> bit_count(x & ~y)), 0, (s, v) -> s + v)"
    asking, parts = _dealt(pairs)
    unions = unions.join(parts, ["gkey", "block"])
    bound = asking.join(sets.withColumnRenamed("num", "asker"), "asker").join(unions, ["gkey", "block", "part"]).where(  # bitmaps of unlike length (sizes astride a power of two) pass
        f"size(bits) <> size(union_bits) or 100 * {missing} <= n * {100 - percent}")
    return placed, materialize(bound.select("asker", "gkey", "block"), "group-pairs")


def linked_classes(wanted: DataFrame, postings: DataFrame, keyed: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``(num, root)`` for every candidate class: the least class of its component."""
    with scratch_tables() as scratch:
        roots = _settled(wanted, keyed, shingle, percent)
        placed, pairs = _asked(wanted, postings, roots, percent)
        if pairs.isEmpty():
            return scratch.keep(roots)
        places = placed.select("num", "gkey", "block")
        opened = pairs.select("gkey", "block").distinct().join(places, ["gkey", "block"]).select("num")
        needed = opened.union(pairs.select(F.col("asker").alias("num"))).distinct()
        chosen = wanted.join(needed, "num").withColumns({"block": F.lit(0).cast("long"), "blocks": F.lit(1).cast("long")})
        sets = _whole_sets(keyed, chosen, shingle).select("num", "tokens").join(roots, "num")

        asking, parts = _dealt(pairs)
        asking = asking.withColumnRenamed("asker", "num").join(sets, "num")
        opened = parts.join(places, ["gkey", "block"]).join(sets, "num").select("gkey", "block", "part", "num", "root", "tokens")
        keys = ["gkey", "block", "part"]
        asking = asking.toDF(*asking.columns)  # names of its own: both sides come from one table
        links = opened.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInPandas(_open(percent), _LINKS)
        over = connected_components(links).select(F.col("node").alias("root"), F.col("root").alias("up"))
        return scratch.keep(materialize(
            roots.join(over, "root", "left").select("num", F.coalesce("up", "root").alias("root")), "shingle-roots"))


def _met(postings: DataFrame) -> DataFrame:
    """``postings`` of tokens that several classes hold, with the number of those classes."""
    with scratch_tables() as scratch:
        several = materialize(postings.groupBy("token").agg(F.count(F.lit(1)).alias("held")).where("held > 1"), "shared-tokens")
        return scratch.keep(materialize(maybe_in(postings, ["token"], several).join(several, "token"), "shared-postings"))


def _shared_postings(classes: DataFrame, keyed: DataFrame, common: Commonness, shingle: int, percent: int) -> DataFrame:
    """``(num, token, held)`` of prefix tokens that several classes hold, under the final order.

    Shingles that turn out to be in many prefixes go to the end of the order;
    only classes that held one get a new prefix.
    """
    spark = classes.sparkSession
    frequent, ranks = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    every = classes.select("num", F.explode("prefix").alias("token"))
    with scratch_tables() as scratch:
        postings, fresh = _met(every), None
        for turn in range(REORDERINGS):
            hot = postings.where(F.col("held") >= FREQUENT).groupBy("token").agg(F.first("held").alias("held"))
            found = np.asarray(hot.orderBy(F.desc("held"), "token").limit(MAX_FREQUENT).toArrow()["token"]).view(np.uint64)
            found = found[~np.isin(found, frequent)][:MAX_FREQUENT - len(frequent)]
            if not len(found):
                break
            frequent, ranks = np.append(frequent, found), np.append(
                ranks, (REORDERINGS - turn) * 2 * MAX_FREQUENT + np.arange(len(found), 0, -1))
            names = spark.createDataFrame(pa.table({"token": found.view(np.int64)}))
            moved = materialize(postings.join(F.broadcast(names), "token", "left_semi").select("num").distinct(), "moved-classes")
            scratch.drop(postings)
            again = classes.join(moved, "num").select("num", "cls", "least.ord", "least.th")
            order = _order(spark, frequent, ranks, common)
            new = materialize(_texts_of(keyed, again).mapInArrow(
                _reordered(shingle, percent, order), "num long, token long"), "moved-postings")
            fresh = new if fresh is None else new.unionByName(fresh.join(moved, "num", "left_anti"))
            # Who holds a frequent shingle has moved, so who stays is known in place: no shuffle but that of the counts.
            stay = classes.select("num", "prefix").mapInArrow(_untouched(order), "num long, token long")
            postings = _met(stay.unionByName(fresh))
        return scratch.keep(postings)


def _order(spark, frequent: np.ndarray, ranks: np.ndarray, common: Commonness):
    """The common order of tokens, as every task needs it: of a fixed size at most."""
    return spark.sparkContext.broadcast((HashIndex(frequent), np.append(ranks[np.argsort(frequent)], 0), common))


def _components(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``doc_id, th, n_shingles, head`` per row of ``(doc_id, text, th)``; head is the least (id, text hash) of the component."""
    with scratch_tables() as scratch, arrow_rows(docs.sparkSession, BATCH_ROWS):
        common = Commonness(*top_words(docs, RANKED_WORDS, exact=False))  # fixed sizes: RANKED_WORDS words, MAX_FREQUENT shingles
        order = _order(docs.sparkSession, np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), common)
        signed = materialize(docs.mapInArrow(
            _signature(shingle, percent, order),
            "doc_id long, th long, n_shingles long, cls binary, gkey long, prefix array<long>, bits array<long>"),
            "shingle-signatures")
        row = F.struct(F.coalesce("doc_id", F.lit(int(NULL_ID))).alias("ord"), "th")
        classes = materialize(signed.where("cls is not null").groupBy("cls").agg(
            F.min(row).alias("least"), F.first("gkey").alias("gkey"), F.first("prefix").alias("prefix"),
            F.first("bits").alias("bits"), F.first("n_shingles").alias("n")).withColumn(
            "num", F.monotonically_increasing_id()), "shingle-classes")
        rows = materialize(signed.select("doc_id", "th", "n_shingles", "cls"), "shingle-rows")
        scratch.drop(signed)  # prefixes and bitmaps are wanted once per class from here on
        keyed = docs.withColumn("ord", F.coalesce("doc_id", F.lit(int(NULL_ID))))

        postings = _shared_postings(classes, keyed, common, shingle, percent)
        # Classes of one family hold the same frequent token, which makes them one group; others group by their least shingles.
        family = postings.groupBy("num").agg(F.max(F.struct("held", "token")).alias("most")).select(
            "num", F.when(F.col("most.held") >= FREQUENT, F.col("most.token")).alias("family"))
        wanted = materialize(classes.join(family, "num").select(
            "num", "cls", F.when(F.col("family").isNull(), F.col("gkey")).otherwise(F.xxhash64("family", F.size("bits"))).alias("gkey"),
            "n", "bits", "least.ord", "least.th"), "shingle-wanted")
        least = materialize(classes.select("num", "cls", "least"), "shingle-least")
        scratch.drop(classes)
        roots = linked_classes(wanted, postings.select("num", "token"), keyed, shingle, percent)

        heads = roots.join(least.select("num", "least"), "num").groupBy("root").agg(F.min("least").alias("head"))
        heads = roots.join(heads, "root").select("num", "head")
        named = least.join(heads, "num", "left").select("cls", F.coalesce("head", "least").alias("head"))
        linked = rows.where("cls is not null").join(named, "cls").select("doc_id", "th", "n_shingles", "head")
        alone = rows.where("cls is null").select(
            "doc_id", "th", "n_shingles", F.lit(None).cast(linked.schema["head"].dataType).alias("head"))
        return scratch.keep(materialize(linked.unionByName(alone), "shingle-heads"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per document: components of Jaccard >= ``percent`` % over ``shingle`` words."""
    docs = doc_columns(docs, id_col, text_col).withColumn("th", F.xxhash64("text"))
    ids = F.when(F.col("head").isNull(), F.col("doc_id")).when(F.col("head.ord") != NULL_ID, F.col("head.ord"))
    return _components(docs, shingle, percent).select("doc_id", "n_shingles", ids.alias("component_id"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                     percent: int = 80) -> DataFrame:
    """``docs`` with one row, of the least id, from each component; texts without words stay.  All columns are kept."""
    # Own names for everything added, whatever columns the table has.
    o, t, n, stay, maybe = fresh_names(docs, "own_ord", "own_th", "own_rows", "own_stays", "own_maybe")
    own = [F.coalesce(docs[id_col].cast("long"), F.lit(int(NULL_ID))).alias(o), F.xxhash64(docs[text_col].cast("string")).alias(t)]
    slim = doc_columns(docs, id_col, text_col).withColumn("th", F.xxhash64("text"))
    rows = _components(slim, shingle, percent).where("head is not null").select(
        F.coalesce("doc_id", F.lit(int(NULL_ID))).alias(o), F.col("th").alias(t), "head")
    rows = rows.groupBy(o, t, "head").agg(F.count(F.lit(1)).alias(n))
    is_head = (F.col("head.ord") == F.col(o)) & (F.col("head.th") == F.col(t))
    decided = materialize(rows.select(o, t, n, is_head.alias(stay)), "near-duplicate-rows")
    changed = decided.where(~F.col(stay) | (F.col(n) > 1))  # all other rows simply stay

    marked = maybe_in(docs.select("*", *own), [o, t], changed, flag=maybe)
    sure = marked.where(~F.col(maybe)).select(*docs.columns)
    met = marked.where(maybe).join(changed, [o, t], "left")
    stays = met.where(F.col(stay).isNull()).select(*docs.columns)
    heads = met.where(stay).dropDuplicates([o, t]).select(*docs.columns)
    return sure.unionByName(stays).unionByName(heads)
