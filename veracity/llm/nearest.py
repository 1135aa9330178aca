"""Approximate nearest neighbours from randomly rotated one-bit codes.

* **Codes.** Vectors are centred on the nearest of ``k`` centres, scaled to
  unit length, rotated by one random orthogonal matrix and kept as sign bits
  with two scalars: the distance to the centre and the inner product of the
  unit vector with its own code.
* **Estimate.** The inner product of a rotated query with the packed bits,
  divided by that scalar, estimates the true one without bias; its error is
  bounded with the scalar and the dimension (``EPSILON`` deviations).
* **Rerank.** Only vectors whose lower distance bound does not exceed the
  tenth least upper bound are compared exactly, in double precision.

The centres come from at most ``SAMPLE`` vectors (least hashes of their ids);
every vector is indexed.  A query visits as many nearest cells as hold
``TARGET`` of the sample's own neighbours (or ``probes``); empty cells do not
count, and it goes on until the visited cells hold as many vectors as that
number of average cells, and ``k`` others in any case.  Cells are dealt into blocks of about ``BLOCK`` vectors and queries into parts, so a
vector held by a third of all rows fills many small tasks; each block returns
its ten best per query, merged by an aggregate that never gathers more.

Defined cases: null, zero or non-finite vectors take no part, nor do null ids;
vectors of another length than the commonest are left out; a repeated id is a
candidate for every other id, once per id and vector, and asks with the least
of its vectors; extra columns are ignored; fewer than ``k`` candidates are all returned.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracity.session import materialize

SAMPLE, MAX_CENTRES, CELL, BLOCK, QUERY_PART = 20_000, 4096, 2048, 4096, 512
EPSILON, TARGET = 3.0, 0.97


def valid_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, v)`` of usable rows, as doubles."""
    rows = table.select(table[id_col].cast("long").alias("vec_id"), table[vector_col].cast("array<double>").alias("v"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = rows.where("vec_id is not null and size(v) > 0").where(~F.exists("v", lambda x: F.coalesce(bad(x), F.lit(True))))
    return rows.where(F.exists("v", lambda x: x != 0))


class Quantizer:
    """Centres and rotation: all that is needed to encode a vector, of a fixed size."""

    def __init__(self, sample: np.ndarray, cells: int):
        rng = np.random.default_rng(41)
        self.dim = sample.shape[1]
        self.rotation = np.linalg.qr(rng.normal(size=(self.dim, self.dim)))[0]
        distinct = np.unique(sample, axis=0)
        self.centres = distinct[rng.permutation(len(distinct))[:cells]]
        for _ in range(8):
            near = self.cells(sample, 1)[:, 0]
            for c in range(len(self.centres)):
                if (near == c).any():
                    self.centres[c] = sample[near == c].mean(axis=0)

    def cells(self, x: np.ndarray, probes: int) -> np.ndarray:
        """The nearest centres of each vector, nearest first."""
        d = (self.centres**2).sum(axis=1) - 2 * x @ self.centres.T
        return np.argsort(d, axis=1, kind="stable")[:, :probes]

    def probes(self, sample: np.ndarray, k: int) -> int:
        """Cells to visit so that ``TARGET`` of the sample's own nearest neighbours lie in them."""
        queries = sample[:: max(1, len(sample) // 256)]
        d = (sample**2).sum(axis=1) - 2 * queries @ sample.T
        near = np.argpartition(d, min(k + 1, len(sample) - 1), axis=1)[:, :k + 1]
        order, home = self.cells(queries, len(self.centres)), self.cells(sample, 1)[:, 0]
        place = np.argsort(order, axis=1)
        return int(np.quantile(place[np.arange(len(queries))[:, None], home[near]], TARGET)) + 1

    def encode(self, x: np.ndarray, cell: np.ndarray):
        """Packed sign bits, distance to the centre, inner product of the unit vector with its code."""
        rest = x - self.centres[cell]
        length = np.linalg.norm(rest, axis=1)
        unit = rest / np.maximum(length, 1e-300)[:, None] @ self.rotation
        bits = unit > 0
        own = np.where(bits, unit, -unit).sum(axis=1) / np.sqrt(self.dim)
        return np.packbits(bits, axis=1), length, own

    def bounds(self, query: np.ndarray, centre: int, codes: np.ndarray, length: np.ndarray, own: np.ndarray):
        """Lower and upper bounds of the squared distances from a query to the encoded vectors of a cell."""
        rest = query - self.centres[centre]
        q_len = np.linalg.norm(rest)
        unit = rest / max(q_len, 1e-300) @ self.rotation
        signs = np.unpackbits(codes, axis=1, count=self.dim).astype(np.float32)
        product = (2 * (signs @ unit.astype(np.float32)) - unit.sum()) / np.sqrt(self.dim)
        own = np.maximum(own, 1e-9)
        guess = product / own
        error = EPSILON * np.sqrt(np.maximum(1 - own**2, 0)) / own / np.sqrt(max(self.dim - 1, 1)) + 1e-5
        base, scale = q_len**2 + length**2, 2 * q_len * length
        return base - scale * (guess + error), base - scale * (guess - error)


_CODED = pa.schema([("cell", pa.int32()), ("vec_id", pa.int64()), ("v", pa.binary()), ("code", pa.binary()),
                    ("length", pa.float64()), ("own", pa.float64())])
_VISIT = pa.schema([("cell", pa.int32()), ("query_id", pa.int64()), ("v", pa.binary())])


def _matrix(column, dim: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dim)


def _code(shared):
    def run(batches):
        quantizer = shared.value
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("v"), quantizer.dim)
                cell = quantizer.cells(x, 1)[:, 0]
                codes, length, own = quantizer.encode(x, cell)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell, pa.int32()), batch.column("vec_id"), pa.array([r.tobytes() for r in x], pa.binary()),
                     pa.array([r.tobytes() for r in codes], pa.binary()), pa.array(length), pa.array(own)], schema=_CODED)

    return run


def _visits(shared, probes: int, load: np.ndarray, least: int):
    """Cells a query visits, nearest first: at least ``probes`` that hold something, and on until they hold ``least`` vectors."""

    def run(batches):
        quantizer = shared.value
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("v"), quantizer.dim)
                cells = quantizer.cells(x, len(quantizer.centres))
                held = load[cells]
                before = np.cumsum(held, axis=1) - held
                wanted = (held > 0) & ((np.cumsum(held > 0, axis=1) <= probes) | (before < least))
                rows, (at, place) = [r.tobytes() for r in x], np.nonzero(wanted)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells[at, place], pa.int32()), batch.column("vec_id").take(pa.array(at)),
                     pa.array([rows[i] for i in at], pa.binary())], schema=_VISIT)

    return run


def _best(shared, k: int):
    """The k nearest of one block for each query of one part."""

    def fn(cell: pd.DataFrame, visits: pd.DataFrame) -> pd.DataFrame:
        quantizer, out = shared.value, {"query_id": [], "vec_id": [], "score": []}
        if len(cell) and len(visits):
            x = np.frombuffer(b"".join(cell["v"])).reshape(len(cell), -1)
            codes = np.frombuffer(b"".join(cell["code"]), dtype=np.uint8).reshape(len(cell), -1)
            length, own, ids = cell["length"].to_numpy(), cell["own"].to_numpy(), cell["vec_id"].to_numpy()
            centre = int(cell["cell"].iloc[0])
            for query, raw in zip(visits["query_id"], visits["v"]):
                q = np.frombuffer(raw)
                low, high = quantizer.bounds(q, centre, codes, length, own)
                other = ids != query
                low, high = np.where(other, low, np.inf), np.where(other, high, np.inf)
                limit = np.partition(high, k - 1)[k - 1] if len(high) > k else np.inf
                open_ = np.flatnonzero((low <= limit) & other)
                score = np.sqrt(((x[open_] - q) ** 2).sum(axis=1))
                first = np.lexsort((ids[open_], score))[:k]
                out["query_id"] += [query] * len(first)
                out["vec_id"] += ids[open_][first].tolist()
                out["score"] += score[first].tolist()
        return pd.DataFrame(out)

    return fn


def _deal(id_col: str, blocks: str) -> Column:
    return F.pmod(F.xxhash64(id_col), F.col(blocks))


def nearest(table: DataFrame, query_mod: int = 100, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
            probes: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest vectors of each id divisible by ``query_mod``."""
    spark, result = table.sparkSession, "query_id long, rank int, vec_id long, score double"
    rows = valid_vectors(table, id_col, vector_col)
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    if sizes is None:
        return spark.createDataFrame([], result)
    rows = rows.where(F.size("v") == sizes["dim"])
    sample = rows.withColumn("h", F.xxhash64("vec_id")).orderBy("h", "v").limit(SAMPLE).select("v").collect()
    cells = int(min(MAX_CENTRES, max(1, sizes["n"] // CELL)))
    sample = np.array([r["v"] for r in sample])
    quantizer = Quantizer(sample, cells)
    probes = probes or quantizer.probes(sample, k)
    shared = spark.sparkContext.broadcast(quantizer)

    coded = rows.mapInArrow(_code(shared), "cell int, vec_id long, v binary, code binary, length double, own double")
    coded = materialize(coded.dropDuplicates(["vec_id", "v"]), "vector-codes")
    queries = rows.where(F.col("vec_id") % query_mod == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    load, own = np.zeros(len(quantizer.centres), dtype=np.int64), 1
    for r in coded.groupBy("cell").count().collect():  # at most MAX_CENTRES rows
        load[r["cell"]] = r["count"]
    if not queries.isEmpty():  # vectors that share a query's id are none of its candidates
        own = coded.where(F.col("vec_id") % query_mod == 0).groupBy("vec_id").count().agg(F.max("count")).first()[0]
    least = max(k + own, probes * int(np.ceil(load.sum() / max(1, (load > 0).sum()))))
    visits = queries.select("vec_id", "v").mapInArrow(_visits(shared, probes, load, least), "cell int, query_id long, v binary")
    visits = materialize(visits, "vector-visits")
    load = coded.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("blocks")).join(
        visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERY_PART).cast("long").alias("parts")), "cell")
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    left = coded.join(load, "cell").withColumn("block", _deal("vec_id", "blocks")).withColumn("part", upto("parts")).drop(
        "blocks", "parts")
    right = visits.join(load, "cell").withColumn("part", _deal("query_id", "parts")).withColumn("block", upto("blocks")).select(
        "cell", "block", "part", "query_id", "v")
    keys = ["cell", "block", "part"]
    right = right.toDF(*right.columns)  # names of its own: both sides share a table
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        _best(shared, k), "query_id long, vec_id long, score double")
    ranked = found.distinct().selectExpr("*", "row_number() over (partition by query_id order by score, vec_id) as rank")
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
