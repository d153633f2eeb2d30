"""SimHash near-duplicates: exact Hamming pairs by vantage-point trees.

Distances between 64-bit fingerprints of unrelated texts crowd around 32 (one
standard deviation is 4), so a vantage-point tree over whole fingerprints
prunes next to nothing at radius 4: half of the rows lie in the overlap of
every split.  The fingerprint is therefore cut into ``blocks`` parts; two
fingerprints within ``max_bits`` differ by at most ``max_bits // blocks`` in
one of them, and each part has its own tree with that much smaller radius.
With more blocks than ``max_bits`` that radius is 0: the bounds prune all
branches but one and a fingerprint lies in one shard per block.  With fewer
blocks the shards overlap at their boundaries (same pairs, more rows).

* Fitting: vantage points and median radii come from a bounded sample of
  fingerprints (``sample_rows``); they decide only how rows are dealt.
* Dealing: a row goes to the side of its distance; by the triangle inequality
  only rows of the inner side within the radius of the boundary can have a
  partner outside, and those also go there.  Every other branch is pruned.
* Query: rows that meet in a shard are compared on all 64 bits.  A shard emits
  a spanning forest of its links, never all pairs of a group; a shard that
  equal block values keep large is dealt to pairs of tiles.

Equal fingerprints are one row before any of this.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, hash_sample, packed, small, text_key
from .graph import components

PIECE = 1 << 16  # shingles hashed at a time
BROADCAST_ROWS = 200_000
HOT = 1000  # rows of one fingerprint that are labelled by broadcast
TILE = 1 << 15  # fingerprints of a shard compared in one task


def _fingerprint(text: bytes | None, width: int) -> bytes:
    """Eight bytes, first bit first; zero without words.  ``bytes.lower`` and
    ``bytes.split`` know ASCII only, which is what the definition asks for."""
    words = (text or b"").lower().split()
    if not words:
        return bytes(8)
    if len(words) < width:
        return xxhash.xxh64_digest(b" ".join(words), 42)
    n = len(words) - width + 1
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[width - 1:] - 1).tolist()
    line, digest = b" ".join(words), xxhash.xxh64_digest
    ones = np.zeros(64, np.int64)
    for i in range(0, n, PIECE):
        hashes = b"".join([digest(line[a:b], 42) for a, b in zip(starts[i:i + PIECE], stops[i:i + PIECE])])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int32)
    return np.packbits(2 * ones > n).tobytes()


def fingerprints(docs: DataFrame, width: int = 4, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, fp): the SimHash of every row as a signed 64-bit integer.

    Null and blank texts have fingerprint zero.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = b"".join([_fingerprint(t.as_py(), width) for t in batch.column("text")])
            fps = np.frombuffer(raw, ">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fps)], names=["id", "fp"])

    return slim.mapInArrow(run, slim.select("id").withColumn("fp", F.lit(0).cast("long")).schema)


def _parts(blocks: int) -> list[tuple[int, int]]:
    """(shift, mask) of each block of the 64 bits."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [(a, (1 << (b - a)) - 1) for a, b in zip(edges, edges[1:])]


def fit_tree(values: np.ndarray, radius: int, leaf_rows: float, rng: np.random.Generator):
    """Nested (vantage, boundary, inner, outer); a leaf is its number."""
    leaves = iter(range(1 << 30))

    def grow(own: np.ndarray, depth: int):
        if len(own) > leaf_rows and depth < 40:
            for vantage in rng.choice(own, min(4, len(own))):
                d = np.bitwise_count(own ^ vantage)
                boundary = int(np.median(d))
                inner = d <= boundary
                if inner.all():
                    boundary -= 1
                    inner = d <= boundary
                outer = d > boundary - radius
                # a split that leaves one side as large as before is none
                if inner.any() and max(inner.sum(), outer.sum()) < 0.95 * len(own):
                    return (int(vantage), boundary, grow(own[inner], depth + 1), grow(own[outer], depth + 1))
        return next(leaves)

    return grow(values, 0)


def deal(tree, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of every row in every leaf that its ball may reach."""
    rows, at = [], []

    # few distinct values: a block of 13 bits has 8192
    values, where = np.unique(values, return_inverse=True)

    def walk(node, own: np.ndarray) -> None:
        if not len(own):
            return
        if isinstance(node, int):
            rows.append(own)
            at.append(np.full(len(own), node, np.int64))
            return
        vantage, boundary, inner, outer = node
        d = np.bitwise_count(values[own] ^ vantage)
        walk(inner, own[d <= boundary])
        walk(outer, own[d > boundary - radius])

    walk(tree, np.arange(len(values)))
    none = np.zeros(0, np.int64)
    value, leaf = np.concatenate(rows or [none]), np.concatenate(at or [none])
    # from (value, leaf) to (row, leaf): every row of a value goes where the value does
    by_value = np.argsort(value, kind="stable")
    value, leaf = value[by_value], leaf[by_value]
    first = np.searchsorted(value, where)
    count = np.searchsorted(value, where, side="right") - first
    row = np.repeat(np.arange(len(where)), count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    return row, leaf[np.repeat(first, count) + step]


def spanning_links(fps: np.ndarray, max_bits: int) -> tuple[list[int], list[int]]:
    """A forest linking all fingerprints within ``max_bits`` (transitively)."""
    left, right = [], []
    rest = np.unique(fps)
    near = None
    if len(rest) <= 1024:
        near = np.bitwise_count(rest[:, None] ^ rest[None, :]) <= max_bits
        linked = near.sum(axis=1) > 1
        rest = rest[linked]
    while len(rest):
        # one component at a time; a member leaves `rest` once found
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            one = todo.pop()
            hit = np.bitwise_count(rest ^ one) <= max_bits
            if hit.any():
                found = rest[hit]
                rest = rest[~hit]
                left += [int(one)] * len(found)
                right += found.tolist()
                todo += list(found)
    return left, right


def hamming_links(fps: DataFrame, max_bits: int = 4, blocks: int = 5, leaf_rows: int = 256,
                  sample_rows: int = 1 << 15, seed: int = 7) -> DataFrame:
    """(u, v): links that connect exactly the fingerprints within ``max_bits``.

    ``fps``: distinct ``fp`` values, cheap to read several times.  Every pair
    within the bound is connected by links (transitively); no link is longer.
    """
    radius, parts = max_bits // blocks, _parts(blocks)
    n = fps.count()
    # Fit on a bounded sample: the fingerprints with the smallest hashes.
    sample = np.sort(np.array([r[0] for r in hash_sample(fps.select("fp"), sample_rows, n, "fp").collect()],
                              np.int64)).view(np.uint64)
    rng = np.random.default_rng(seed)
    share = max(2.0, leaf_rows * len(sample) / max(1, n))
    trees = [fit_tree((sample >> np.uint64(s)) & np.uint64(m), radius, share, rng) for s, m in parts]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            own = np.concatenate(held).view(np.uint64)
            for b, (shift, mask) in enumerate(parts):
                row, leaf = deal(trees[b], (own >> np.uint64(shift)) & np.uint64(mask), radius)
                for i in range(0, len(row), PIECE):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(leaf[i:i + PIECE] * len(parts) + b),
                         pa.array(own[row[i:i + PIECE]].view(np.int64))], names=["shard", "fp"])

        held, size = [], 0
        for batch in batches:
            held.append(batch.column("fp").to_numpy(zero_copy_only=False))
            size += len(held[-1])
            if size >= PIECE:
                yield from flush(held)
                held, size = [], 0
        if size:
            yield from flush(held)

    dealt = cut(fps.select("fp").mapInArrow(route, "shard long, fp long"))
    # Shards over the tile size: every pair of tiles becomes a task's work.
    large = cut(packed(dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > TILE)
                       .withColumn("tiles", F.ceil(F.col("n") / (TILE // 2)).cast("int")).drop("n"),
                       n * blocks // TILE))
    if large.isEmpty():
        tiled = dealt.withColumn("tile", F.lit(0).cast("long"))
    else:
        tile = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
        pair: Column = F.explode(F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda j: (
            F.least(j, F.col("own")).cast("long") * F.col("tiles") + F.greatest(j, F.col("own")))))
        split = dealt.join(large, "shard").withColumn("own", tile).select("shard", "fp", pair.alias("tile"))
        tiled = (dealt.join(large, "shard", "left_anti").withColumn("tile", F.lit(0).cast("long"))
                 .unionByName(split))
    shards = tiled.groupBy("shard", "tile").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            column = batch.column("fps")
            values = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
            edges = column.offsets.to_numpy()
            for a, b in zip(edges[:-1], edges[1:]):
                u, v = spanning_links(values[a:b], max_bits)
                left += u
                right += v
            pairs = np.array([left, right], np.uint64).reshape(2, -1).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["u", "v"])

    return shards.select("fps").mapInArrow(match, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, width: int = 4, max_bits: int = 4, blocks: int = 5,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: id, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest id reachable over links of at most
    ``max_bits`` differing bits.  Null and blank texts share fingerprint zero
    and link like any other; null ids are kept and never name a component (a
    component of null ids only has a null name); repeated rows are repeated;
    other columns are ignored; an empty table gives no rows.
    """
    slim = cut(fingerprints(docs, width, id_col, text_col))
    rows = slim.count()
    classes = cut(packed(slim.groupBy("fp").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")), rows))
    links = hamming_links(classes.select("fp"), max_bits, blocks)
    member = components(links, rows=rows * blocks).select(F.col("node").alias("fp"), "component")
    tops = cut(packed(member.join(classes, "fp").groupBy("component").agg(F.min("first").alias("least")), rows))
    named = member.join(small(tops, BROADCAST_ROWS), "component").select("fp", "least")
    labels = cut(packed(classes.join(named, "fp", "left").select(
        "fp", "n", F.coalesce("least", "first").alias("component_id")), rows))
    # fingerprints of very many rows (a row of theirs per HOT rows) are not dealt by value
    hot = small(labels.filter(F.col("n") > HOT).select("fp", "component_id"), BROADCAST_ROWS)
    rest = labels.filter(F.col("n") <= HOT).select("fp", "component_id")
    labelled = (slim.join(hot, "fp").select("fp", "id", "component_id")
                .unionByName(slim.join(hot, "fp", "left_anti").join(rest, "fp").select("fp", "id", "component_id")))
    return packed(labelled, rows).select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id")


def keep_one(docs: DataFrame, width: int = 4, max_bits: int = 4, blocks: int = 5,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group; same columns.

    The row with the smallest id stays (null ids come last, then the smaller
    digest of the text); of rows repeated with id and text one stays.
    """
    names = docs.columns
    keyed = docs.withColumn("__row", F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"),
                                              text_key(F.col(text_col)).alias("text")))
    found = cut(near_duplicates(keyed, width, max_bits, blocks, "__row", text_col))
    rows = found.count()
    surplus = cut(packed(found.filter(F.col("__row") != F.col("component_id")).select("__row").distinct(), rows))
    kept = keyed.join(small(surplus, BROADCAST_ROWS), "__row", "left_anti")
    again = cut(packed(found.filter(F.col("__row") == F.col("component_id")).groupBy("__row")
                       .agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("__row"), rows))
    if not again.isEmpty():
        again = small(again, BROADCAST_ROWS)
        kept = kept.join(again, "__row", "left_anti").unionByName(
            kept.join(again, "__row", "left_semi").dropDuplicates(["__row"]))
    return kept.select(*names)
