"""Nearest neighbours by several shifted Hilbert orderings.

Vectors are projected to a few dimensions by random rotations, shifted, and
ordered along a Hilbert curve, several times over.  Each ordering is cut into
``segments`` of near equal size (boundaries from a bounded sample's keys); a
query meets the vectors of its own and the neighbouring segments of every
ordering, and what it meets is merged and ranked by the exact inner product.

The measure is the inner product, the curve knows distances: vectors get one
more coordinate, sqrt(longest**2 - norm**2), and queries are brought to the
longest norm with 0 there, so that the nearest point is the one with the
largest product whatever the norms.

The window is a share of each ordering, not a number of rows: for vectors
without structure (all directions alike) no curve separates near from far, and
only a share keeps the recall at every size.  A query that met fewer rows than
it asks for meets all of them.  ``curves=1, segments=1`` is the exact search.

Work is dealt by (ordering, segment, block): blocks of vectors and of queries
are bounded, so no task holds a segment whole.  Equal vectors are one row with
their smallest ids, which is all that a result can name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, hash_sample

BLOCK = 8192  # vectors or queries of a task's block


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of rows of ``bits``-bit coordinates.

    The usual transposed form: undo the excess rotations from the top bit
    down, Gray-encode, then interleave the bits.
    """
    x = cells.T.astype(np.uint32).copy()
    dims, one = len(x), np.uint32(1)
    for b in range(bits - 1, 0, -1):
        low = np.uint32((1 << b) - 1)
        for i in range(dims):
            inverted = (x[i] >> np.uint32(b)) & one == 1
            swap = np.where(inverted, np.uint32(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(inverted, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip = np.where((x[dims - 1] >> np.uint32(b)) & one == 1, flip ^ np.uint32((1 << b) - 1), flip)
    x ^= flip
    key = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << np.uint64(1)) | ((x[i] >> np.uint32(b)) & one).astype(np.uint64)
    return key


def lifted(x: np.ndarray, ask: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the coordinate that makes all norms equal; queries scaled to that norm, with 0."""
    norm = np.linalg.norm(x, axis=1)
    extra = np.where(ask, 0.0, np.sqrt(np.maximum(longest ** 2 - norm ** 2, 0.0)))
    scale = np.where(ask, longest / np.maximum(norm, np.finfo(float).tiny), 1.0)
    return np.column_stack((x * scale[:, None], extra))


class Orderings:
    """Rotations, shifts, scales and segment boundaries of all orderings."""

    def __init__(self, sample: np.ndarray, curves: int, segments: int, dims: int, bits: int, seed: int):
        rng = np.random.default_rng(seed)
        width = sample.shape[1]
        self.dims, self.bits = min(dims, width), bits
        self.rotations, self.low, self.scale, self.shift, self.bounds = [], [], [], [], []
        for _ in range(curves):
            rotation = np.linalg.qr(rng.normal(size=(width, width)))[0][:, :self.dims]
            at = sample @ rotation
            spread = np.maximum(2.5 * at.std(axis=0), 1e-12)
            self.rotations.append(rotation)
            self.low.append(at.mean(axis=0) - spread)
            self.scale.append(2 * spread)
            self.shift.append(rng.uniform(0, 0.5, self.dims))
            keys = np.sort(self.keys(sample, len(self.rotations) - 1))
            self.bounds.append(keys[[len(keys) * i // segments for i in range(1, segments)]])

    def keys(self, x: np.ndarray, curve: int) -> np.ndarray:
        unit = ((x @ self.rotations[curve] - self.low[curve]) / self.scale[curve] + self.shift[curve]) / 1.5
        return hilbert_keys((np.clip(unit, 0, 1 - 1e-9) * (1 << self.bits)).astype(np.uint32), self.bits)

    def segment(self, x: np.ndarray, curve: int) -> np.ndarray:
        return np.searchsorted(self.bounds[curve], self.keys(x, curve), side="right")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _nearest(table: pa.Table, keep: int) -> pa.Table:
    """Best ``keep`` vectors of a block for each of its queries."""
    asks = np.array(table.column("ask").to_pylist(), bool)
    x = _matrix(table.column("vec").combine_chunks()).astype(np.float64)
    ids = np.array(table.column("cls").to_pylist(), object)
    queries, rows = np.flatnonzero(asks), np.flatnonzero(~asks)
    out: list[tuple] = []
    quick = x[rows].astype(np.float32)
    names = ids[rows]
    by_name = np.argsort(names.astype(str), kind="stable") if len(names) else np.zeros(0, int)
    quick, rows = quick[by_name], rows[by_name]
    some = min(len(rows), keep + 11)  # single precision chooses a few more than asked for
    for i in range(0, len(queries) if some else 0, 512):
        part = queries[i:i + 512]
        scores = x[part].astype(np.float32) @ quick.T
        near = np.argpartition(-scores, some - 1, axis=1)[:, :some]
        for q, found in zip(part, near):
            exact = x[rows[found]] @ x[q]
            for j in np.argsort(-exact, kind="stable")[:keep]:
                out.append((ids[q], ids[rows[found[j]]], float(exact[j])))
    columns = list(zip(*out)) or [(), (), ()]
    return pa.table({"query": pa.array(columns[0], pa.string()), "cls": pa.array(columns[1], pa.string()),
                     "score": pa.array(columns[2], pa.float64())})


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, curves: int = 8, segments: int = 12,
            dims: int = 6, bits: int = 4, sample_rows: int = 1 << 14, seed: int = 3,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest found by inner product for every id divisible by ``every``.

    Columns: ``query_id``, ``rank`` (from 1), id, ``score`` (double precision).
    Ties go to the smaller id; the query's own id is no candidate.  Rows with a
    null id, a null, empty or zero vector, or one holding null or non-finite
    components take no part, nor do vectors of another length than the most
    frequent one.  Repeated rows count once; an id with two different vectors
    asks with both.  Other columns are ignored; an empty table gives no rows.
    The index is fitted on ``sample_rows`` vectors and holds every vector.
    """
    finite = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = (vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & finite
                            & F.exists(vec_col, lambda x: x != 0))
             .select(F.col(id_col).alias("id"),  # adding 0 makes one zero of the two
                     F.transform(F.col(vec_col).cast("array<double>"), lambda x: x + F.lit(0.0)).alias("vec")))
    width = (valid.groupBy(F.size("vec").alias("w")).agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), F.desc("w")).first())
    if width is None:
        return valid.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"),
                            F.col("id").alias(id_col), F.lit(0.0).alias("score")).limit(0)
    valid = valid.filter(F.size("vec") == width["w"]).distinct()
    # k + 1 smallest ids of each vector; the window keeps no more than that of a map task's rows
    first = (valid.withColumn("n", F.row_number().over(W.partitionBy("vec").orderBy("id")))
             .filter(F.col("n") <= k + 1))
    key = F.md5(F.to_json("vec"))
    classes = cut(first.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
                  .withColumn("key", key)
                  .withColumn("cls", F.concat_ws(":", F.format_string("%020d", F.get("ids", F.lit(0))), "key")))
    # a query's class is computed from its vector: no join on vectors, which copies make a hot key
    asks = cut(valid.filter(F.col("id") % every == 0).select(F.col("id").alias("query_id"), key.alias("key")))
    n, n_asks = classes.count(), asks.select("key").distinct().count()
    if not n_asks:
        return asks.select("query_id", F.lit(0).alias("rank"), F.col("query_id").alias(id_col),
                           F.lit(0.0).alias("score")).limit(0)
    sample = np.array([r["vec"] for r in sorted(
        hash_sample(classes.select("cls", "vec"), sample_rows, n, "cls").collect(), key=lambda r: r["cls"])])
    square = F.aggregate("vec", F.lit(0.0), lambda t, x: t + x * x)
    longest = math.sqrt(classes.agg(F.max(square)).first()[0])
    plan = Orderings(lifted(sample, np.zeros(len(sample), bool), longest), curves, segments, dims, bits, seed)
    blocks = math.ceil(n / segments / BLOCK)
    ask_blocks = math.ceil(3 * n_asks / segments / BLOCK)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vec"))
            if not len(x):
                continue
            ask = np.array(batch.column("ask").to_pylist(), bool)
            mine = np.array(batch.column("h").to_pylist(), np.int64)
            points = lifted(x, ask, longest)
            for c in range(curves):
                at = plan.segment(points, c)
                for others, own, count, shifts in ((blocks, ask_blocks, ask, (-1, 0, 1)),
                                                   (ask_blocks, blocks, ~ask, (0,))):
                    rows = np.flatnonzero(count)
                    for shift in shifts:
                        to = at[rows] + shift
                        inside = rows[(to >= 0) & (to < segments)]
                        for other in range(others):
                            i = mine[inside] % own
                            a, b = (np.full(len(inside), other), i) if count is ask else (i, np.full(len(inside), other))
                            place = ((c * segments + at[inside] + shift) * blocks + a) * ask_blocks + b
                            part = batch.take(pa.array(inside))
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(place.astype(np.int64)), part.column("cls"), part.column("ask"),
                                 part.column("vec")], names=["place", "cls", "ask", "vec"])

    spread = F.pmod(F.xxhash64("cls"), F.lit(1 << 20)).alias("h")
    every_class = classes.select("cls", F.lit(False).alias("ask"), "vec", spread)
    asking = cut(classes.join(asks.select("key").distinct(), "key", "left_semi")
                 .select("cls", F.lit(True).alias("ask"), "vec", spread))

    def scores(dealt: DataFrame) -> DataFrame:
        return (dealt.groupBy("place").applyInArrow(lambda t: _nearest(t, k + 1), "query string, cls string, score double")
                .groupBy("query", "cls").agg(F.max("score").alias("score")))

    dealt = "place long, cls string, ask boolean, vec array<double>"
    met = cut(scores(every_class.unionByName(asking).mapInArrow(deal, dealt)))
    # what met fewer classes than it asks for meets every block of all of them
    enough = met.groupBy("query").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min(k + 1, n))
    short = asking.join(enough, asking["cls"] == enough["query"], "left_anti")
    if n_short := short.count():
        rows, groups = math.ceil(n / BLOCK), math.ceil(n_short / BLOCK)

        def over(df: DataFrame, others: int, place) -> DataFrame:
            each = df.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(others - 1))))
            return each.select(place.alias("place"), "cls", "ask", "vec")

        all_rows = over(every_class, groups, F.col("h") % rows * groups + F.col("o"))
        all_short = over(short, rows, F.col("o") * groups + F.col("h") % groups)
        met = met.join(short, met["query"] == short["cls"], "left_anti").unionByName(scores(all_rows.unionByName(all_short)))

    def best(by: str, *order) -> W:
        return W.partitionBy(by).orderBy(*order)

    top = (met.withColumn("n", F.row_number().over(best("query", F.desc("score"), "cls")))
           .filter(F.col("n") <= k + 1).select("query", "cls", "score"))
    named = (top.join(classes.select("cls", "ids"), "cls")
             .select("query", "score", F.explode("ids").alias("id"))
             .withColumn("n", F.row_number().over(best("query", F.desc("score"), "id")))
             .filter(F.col("n") <= k + 1)
             .groupBy("query").agg(F.array_sort(F.collect_list(F.struct("n", "id", "score"))).alias("found")))
    own = asks.join(named.withColumn("key", F.substring_index("query", ":", -1)), "key")
    without_self = F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, k)
    return own.select("query_id", F.posexplode(without_self).alias("p", "x")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.id").alias(id_col),
        F.col("x.score").alias("score"))
