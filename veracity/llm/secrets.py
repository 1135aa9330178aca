"""Secret scans with corpus-wide ownership frequency, in built-in functions only.

Patterns give candidate spans; ``split`` gives the text between matches, so
positions are running sums of lengths (a window per document and kind).  Each
candidate value is a 128-bit digest, never the secret itself.  Digests are
aggregated over the corpus by independent owners and repositories: copies of a
text, exact or near, give one vote in all, to their first owner.  A value with
votes of ``COPIED_OWNERS`` owners in ``COPIED_REPOS`` repositories or more, and
of more than the binary logarithm of their number in the corpus, is a widely
copied example, any other is *live-looking*.  The method adds bare tokens: a token with
a digit, as long as the least value a base span confirms, whose value some base
span confirms as a credential that is not widely copied.

Copies are told by ``SKETCHES`` least hashes over runs of three words: texts
alike in a share of their runs agree in each hash with that probability.  Votes
are counted by every choice of ``AGREEING`` hashes, so only texts that agree in
most of them share a vote (0.94 of pairs alike in 0.8 of their runs, 0.10 of
those alike in 0.25); the least count stands, so an undecided value is live.

A hot value is counted per task before the shuffle; joins on values are sort
merge joins whose large side Spark may split.

Defined cases: null text is empty; null owners and repositories count as one
unknown each; repeated rows are scanned each; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracity.functions.columns import fresh_names
from veracity.session import materialize

#: The base patterns (kind, pattern, group holding the value).
PATTERNS = (
    ("assign", r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1),
    ("access", r"AKIA[A-Z0-9]{12,}", 0),
    ("hex", r"[0-9a-f]{32,}", 0),
)
ASSIGN_LENGTH, COPIED_OWNERS, COPIED_REPOS, SKETCHES, AGREEING = 8, 3, 3, 5, 3
#: Bare tokens the ownership join may add; a digit is required, so prose is passed over.
BARE = ("bare", rf"(?<![A-Za-z0-9+/_.=-])(?=[A-Za-z+/_.=-]*[0-9])[A-Za-z0-9+/_.=-]{{{ASSIGN_LENGTH},}}", 0)
KINDS = [k for k, _, _ in (*PATTERNS, BARE)]
_CANDIDATE = "array<struct<kind: int, step: int, size: int, value_size: int, value: string>>"


def _matches(text: Column, kind: int, pattern: str, group: int) -> Column:
    """Per match: length of text before it since the last match, its length, its value's length and digest."""
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))
    found = F.transform(F.filter(parts, lambda x: x["whole"].isNotNull()), lambda x: F.struct(
        F.lit(kind).alias("kind"), F.length(x["gap"]).alias("step"), F.length(x["whole"]).alias("size"),
        F.length(x["value"]).alias("value_size"), F.substring(F.sha2(x["value"], 256), 1, 32).alias("value")))
    return F.when(text.rlike(pattern), found).otherwise(F.array()).cast(_CANDIDATE)


def _candidates(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_cols: list[str]) -> DataFrame:
    """One row per document: id, owner, repository, its matches and what tells copies of it; no text."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    known = lambda c: F.coalesce(docs[c].cast("string"), F.lit(""))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), known(owner_col).alias("owner"),
                       F.concat_ws("/", *map(known, repo_cols)).alias("repo"), text.alias("text"),
                       _row_key(docs, id_col, text_col, owner_col, repo_cols).alias("row_key"))
    every = [_matches(F.col("text"), i, pattern, group) for i, (_, pattern, group) in enumerate((*PATTERNS, BARE))]
    words = F.split("text", r"\s+")
    runs = F.arrays_zip(words, F.slice(words, 2, F.size(words)), F.slice(words, 3, F.size(words)))
    rows = rows.select("*", F.concat(*every).alias("found")).select("*", F.when(F.size("found") > 0, runs).alias("runs"))
    sketches = F.array(*(F.array_min(F.transform("runs", lambda x, i=i: F.xxhash64(F.lit(i), x))) for i in range(SKETCHES)))
    return rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "owner", "repo", "row_key", "found",
                       sketches.alias("sketches"))


def _row_key(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_cols: list[str]) -> Column:
    """Rows alike in id, owner, repository and text share a key, and every decision."""
    return F.xxhash64(docs[id_col].cast("long"), *(docs[c].cast("string") for c in (owner_col, *repo_cols, text_col)))


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1), x["start"], x["end"])), ",")


def _judged_spans(rows: DataFrame, copied: bool = False) -> DataFrame:
    """``rid, kind, start, end, base, copied`` of all spans: the base ones, and bare tokens the ownership join adds (``copied`` ones too)."""
    each = rows.where(F.size("found") > 0).select("rid", "owner", "repo", "sketches", F.posexplode("found").alias("at", "m")).select(
        "rid", "owner", "repo", "sketches", "at", "m.*")
    spans = each.selectExpr(
        "rid", "owner", "repo", "sketches", "kind", "value", "value_size", f"kind < {len(PATTERNS)} as base",
        "sum(step + size) over (partition by rid, kind order by at rows unbounded preceding) - size as start", "size")
    spans = spans.where(~((F.col("kind") == 0) & (F.col("value_size") < ASSIGN_LENGTH))).withColumn(
        "end", F.col("start") + F.col("size"))
    spans = materialize(spans, "secret-spans")

    confirmed = spans.where("base").select("value").distinct()
    choices = F.array(*(F.xxhash64(*(F.get("sketches", F.lit(i)) for i in c)) for c in combinations(range(SKETCHES), AGREEING)))
    held = spans.join(confirmed, "value", "left_semi").select("value", "owner", "repo", F.posexplode(choices).alias("by", "sketch"))
    votes = held.groupBy("value", "by", "sketch").agg(F.min(F.struct("owner", "repo")).alias("first"))
    limits = rows.agg(F.count_distinct("owner").alias("owners"), F.count_distinct("repo").alias("repos")).first()
    count = lambda c: votes.groupBy("value", "by", f"first.{c}").agg(F.lit(1).alias("one")).groupBy("value", "by").agg(
        F.count("one").alias("n")).groupBy("value").agg(F.min("n").alias(f"{c}s"))
    enough = lambda c, least: F.col(c) >= max(least, log2(1 + limits[c]))
    values = count("owner").join(count("repo"), "value").select(
        "value", (enough("owners", COPIED_OWNERS) & enough("repos", COPIED_REPOS)).alias("copied"))
    judged = spans.join(values, "value")

    # A bare token inside or across a base span is already covered.  Tokens do not overlap each other, so it is enough
    # to look at the furthest end before it and the nearest start after it.
    judged = judged.selectExpr(
        "rid", "kind", "start", "end", "base", "copied",
        "max(if(base, end, null)) over (partition by rid order by start, kind rows between unbounded preceding "
        "and current row) as reached",
        "min(if(base, start, null)) over (partition by rid order by start, kind rows between current row and "
        "unbounded following) as following")
    clear = (F.coalesce("reached", F.lit(0)) <= F.col("start")) & (F.coalesce("following", F.col("end")) >= F.col("end"))
    return judged.where(F.col("base") | ((F.lit(copied) | ~F.col("copied")) & clear)).drop("reached", "following")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                 repo_cols: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied`` per document."""
    rows = materialize(_candidates(docs, id_col, text_col, owner_col, list(repo_cols)), "secret-candidates")

    span = F.struct("start", "kind", "end")
    per_doc = _judged_spans(rows).groupBy("rid").agg(
        F.collect_list(F.when(F.col("base"), span)).alias("base_spans"), F.collect_list(span).alias("all_spans"),
        *(F.count(F.when(F.col("kind") == i, 1)).alias(f"n_{k}") for i, (k, _, _) in enumerate(PATTERNS)),
        F.count_if(F.col("base") & ~F.col("copied")).alias("n_live"),
        F.count_if(F.col("base") & F.col("copied")).alias("n_copied"))
    return rows.select("rid", "doc_id").join(per_doc, "rid", "left").select(
        "doc_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_assign", "n_access", "n_hex")),
        F.sha2(F.coalesce(_joined("base_spans"), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(_joined("all_spans"), F.lit("")).alias("spans"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_live", "n_copied")))


def mask_secrets(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", owner_col: str = "source",
                 repo_cols: tuple[str, ...] = ("source", "lang"), mask: str = "[SECRET]",
                 copied: bool = False) -> DataFrame:
    """``docs`` with every live-looking secret replaced by ``mask``; all columns stay, and widely copied examples unless ``copied``.

    Only rows in which a pattern matches are joined with their spans;
    overlapping spans (a value seen by two patterns) are masked as one.
    """
    rows = materialize(_candidates(docs, id_col, text_col, owner_col, list(repo_cols)), "secret-candidates")
    spans = _judged_spans(rows, copied).where(F.lit(copied) | ~F.col("copied")).groupBy("rid").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("mask_spans"))
    key, found = fresh_names(docs, "mask_key", "mask_spans")
    spans = rows.select("rid", F.col("row_key").alias(key)).join(spans, "rid").groupBy(key).agg(F.first("mask_spans").alias(found))

    any_match = F.lit(False)
    for _, pattern, _ in (*PATTERNS, BARE):
        any_match = any_match | F.coalesce(docs[text_col].cast("string").rlike(pattern), F.lit(False))
    hit = docs.where(any_match).withColumn(key, _row_key(docs, id_col, text_col, owner_col, list(repo_cols)))
    text, start, end = F.col(text_col).cast("string"), lambda x: x["start"], lambda x: x["end"]
    cut = F.aggregate(
        found, F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda acc, x: F.struct(
            F.greatest(acc["at"], end(x)).alias("at"),
            F.when(start(x) >= acc["at"], F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (start(x) - acc["at"])
                                                                          .cast("int")), F.lit(mask))).otherwise(acc["out"]).alias("out")),
        lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    done = hit.join(spans, key, "left").withColumn(text_col, F.when(F.col(found).isNull(), text).otherwise(cut))
    return docs.where(~any_match).unionByName(done.select(*docs.columns))
