"""Minimax contiguous sharding of atomic groups.

Rows with equal content form an atomic group.  Groups are ordered by their
content digest; the shards are contiguous runs of that order, cut so that the
largest shard is as small as possible: a binary search over the capacity with
a greedy feasibility check, then cuts at that capacity.

The order has as many elements as there are groups, so the search never sees
it whole.  The driver holds a table of *atoms*: digest prefixes with their
summed size.  Treating atoms as indivisible gives a feasible (upper) capacity;
``max(largest group, ceil(total / shards))`` is a lower one.  Only atoms that
can hold a cut for some capacity between the two are split by one more hex
digit (one small aggregation per round), until those atoms are single groups
and the capacity is exact.  With ``n`` shards about ``n * n`` atoms are open
per round whatever the number of rows, so the driver's share is bounded.

A group larger than an even share of what is left gets a shard of its own (it
bounds the largest shard in any case); the others share the remaining shards.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut


def _greedy(prefix: np.ndarray, capacity: int, shards: int) -> list[int]:
    """Cut positions of the greedy fill (indices into ``prefix``), ``shards`` of them."""
    at, cuts = 0, []
    for _ in range(shards):
        at = int(np.searchsorted(prefix, prefix[at] + capacity, side="right")) - 1
        cuts.append(at)
    return cuts


def _capacity(prefix: np.ndarray, shards: int, low: int) -> int:
    """Smallest capacity >= ``low`` whose greedy fill reaches the end."""
    high = int(prefix[-1])
    low = min(low, high)
    while low < high:
        mid = (low + high) // 2
        if _greedy(prefix, mid, shards)[-1] == len(prefix) - 1:
            high = mid
        else:
            low = mid + 1
    return low


def _open_atoms(sizes: np.ndarray, single: np.ndarray, shards: int, low: int, high: int) -> np.ndarray:
    """Divisible atoms in which a cut may fall for a capacity in [low, high]."""
    prefix = np.concatenate(([0], np.cumsum(sizes)))
    blocked = (sizes > low) & ~single
    if blocked.any():  # the coarse greedy fill can't pass these: split them first
        return np.flatnonzero(blocked)
    touched = np.zeros(len(sizes), bool)
    for i, at in enumerate(_greedy(prefix, low, shards), 1):
        last = int(np.searchsorted(prefix, i * high, side="right"))
        touched[at:last + 1] = True
    return np.flatnonzero(touched & ~single)


def find_cuts(rows: DataFrame, shards: int, total: int, largest: int,
              digits: int | None = None) -> tuple[int, list[str]]:
    """(capacity, first digest prefix of every shard but the first).

    ``rows``: (digest string, size long), one or more rows per group.
    """
    digits = digits or max(1, min(6, math.ceil(math.log(16 * shards * shards, 16))))

    def atoms(of: DataFrame, n: int) -> list[tuple[str, int, bool]]:
        got = (of.groupBy(F.substring("digest", 1, n).alias("prefix"))
               .agg(F.sum("size").alias("size"),
                    (F.min("digest") == F.max("digest")).alias("single")).collect())
        return [(r["prefix"], r["size"], r["single"]) for r in got]

    low = max(largest, -(-total // shards))
    have = sorted(atoms(rows, digits))
    while True:
        sizes = np.array([x[1] for x in have], np.int64)
        single = np.array([x[2] for x in have], bool)
        prefix = np.concatenate(([0], np.cumsum(sizes)))
        high = _capacity(prefix, shards, low)
        todo = [] if high <= low else _open_atoms(sizes, single, shards, low, high)
        if not len(todo):
            break
        out = {have[i][0] for i in todo}
        have = [x for x in have if x[0] not in out]
        for n in sorted({len(p) for p in out}):
            own = sorted(p for p in out if len(p) == n)
            have += atoms(rows.filter(F.substring("digest", 1, n).isin(own)), n + 1)
        have.sort()
    ends = _greedy(prefix, high, shards)
    return high, [have[i][0] for i in ends[:-1] if i < len(have)]


def minimax_shards(rows: DataFrame, shards: int = 40, cells: int = 256) -> DataFrame:
    """Place rows of atomic groups into contiguous shards of minimal largest size.

    ``rows`` has ``digest`` (hex string, one per group, never null), ``size``
    (long) and any other columns; it must be cheap to read several times.
    Adds ``shard`` (int, from 0) and ``slot`` (long, gapless from 0 in each
    shard).  Rows of one digest share a shard.  With fewer groups than shards
    some shards stay empty; an empty table gives an empty result.  Repeated
    rows each get a slot; which of two identical rows comes first is open.

    Slots are counted over ``shards * cells`` cells, so a group holding a third
    of all rows is numbered by many tasks.
    """
    # A fixed-size report: the groups that may need a shard of their own.
    top = (rows.groupBy("digest").agg(F.sum("size").alias("size"))
           .orderBy(F.desc("size"), "digest").limit(shards).collect())
    total = rows.agg(F.sum("size")).first()[0] or 0
    giants: list[str] = []
    for r in top:
        if len(giants) < shards - 1 and r["size"] * (shards - len(giants)) > total:
            giants.append(r["digest"])
            total -= r["size"]
        else:
            break
    rest = rows.filter(~F.col("digest").isin(giants)) if giants else rows
    largest = next((r["size"] for r in top if r["digest"] not in giants), 0)
    shard: Column = F.lit(0)
    if total:
        _, cuts = find_cuts(rest.select("digest", "size"), shards - len(giants), total, largest)
        for c in cuts:
            shard = shard + (F.col("digest") >= F.lit(c)).cast("int")
    for i, g in enumerate(giants):
        shard = F.when(F.col("digest") == g, F.lit(shards - len(giants) + i)).otherwise(shard)

    others = [c for c in rows.columns if c not in ("digest", "size")]
    cell = F.pmod(F.xxhash64("digest", *others), F.lit(cells)).cast("int")
    placed = rows.withColumn("shard", shard.cast("int")).withColumn("__cell", cell)
    counts = placed.groupBy("shard", "__cell").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        "shard", "__cell",
        (F.sum("__n").over(W.partitionBy("shard").orderBy("__cell")) - F.col("__n")).alias("__before"))
    within = W.partitionBy("shard", "__cell").orderBy("digest", *others)
    # at most shards * cells rows
    return (placed.join(F.broadcast(offsets), ["shard", "__cell"])
            .withColumn("slot", F.col("__before") + F.row_number().over(within) - 1)
            .drop("__cell", "__before"))


def shard_documents(docs: DataFrame, shards: int = 40, id_col: str = "doc_id",
                    text_col: str = "text", overhead: int = 16) -> DataFrame:
    """Shards of near equal bytes; equal texts stay together.

    Returns id, ``size`` (UTF-8 bytes plus ``overhead``), ``text_crc32``,
    ``shard``, ``slot``.  A null text has no bytes (size ``overhead``, CRC 0)
    and goes with the empty texts; null ids are kept; columns other than id
    and text are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = cut(docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.substring(F.sha2(text, 256), 1, 32).alias("digest")))
    return (minimax_shards(slim, shards)
            .select(F.col("id").alias(id_col), "size", "text_crc32", "shard", "slot"))
