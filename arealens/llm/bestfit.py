"""Best-fit packing: combinations that fill a sequence exactly, then best fit.

Documents are encoded once; only those longer than a sequence are cut.  What
has to be packed is then a number per length: a histogram of at most
``window`` entries, whatever the table's size.

* Exact complements: from the longest length down, the gap that a piece leaves
  is looked up among the available lengths, the sums of two and of three of
  them (an index of pair sums says whether a search can succeed).  A
  combination that fills the gap is consumed as often as the scarcest of its
  lengths allows, so every step uses up a length or exhausts its combinations.
* Best fit: what has no exact complement goes, longest first, into the open
  sequences with the smallest sufficient gap.

Both work on counts, so the plan is a few thousand segments ("the pieces of
length L ranked from a to b go to the sequences from s on, at offset o").  A
piece's rank among its length is its place within its task, counted while the
task encodes, plus the pieces of that length in the tasks before.  No length
is gathered anywhere, however many pieces have it.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealens.operators.selection import bounded_broadcast

from .common import cut
from .tokens import byte_vocabulary, default_vocabulary

ROWS = 4096  # pieces in an output batch


@dataclass(frozen=True)
class Segment:
    """Pieces of ``length`` ranked ``first`` to ``last`` (exclusive): ``each`` of them
    lie in one sequence, one behind the other from ``offset``; sequences count from ``sequence``."""
    length: int
    first: int
    last: int
    each: int
    sequence: int
    offset: int


def complement(gap: int, top: int, free: np.ndarray, pairs: np.ndarray, most: int = 3) -> tuple[int, ...] | None:
    """One, two or three (at ``most``) available lengths of at most ``top`` that add up to
    ``gap``, those with the longest first part first; ``free[n]`` counts pieces of length n."""
    if most and gap <= top and free[gap]:
        return (gap,)
    if most < 2:
        return None
    firsts = np.flatnonzero(free[:min(top, gap - 1) + 1])[::-1]
    for a in firsts.tolist():
        b = gap - a
        if b > a:
            break
        if free[b] > (a == b):
            return a, b
    for a in firsts.tolist() if most > 2 else ():
        rest = gap - a
        if rest > 2 * a:
            break
        if not pairs[rest]:
            continue
        seconds = np.flatnonzero(free[:min(a, rest - 1) + 1])[::-1]
        seconds = seconds[2 * seconds >= rest]
        for b in seconds[free[rest - seconds] > 0].tolist():
            need = Counter((a, b, rest - b))
            if all(free[n] >= k for n, k in need.items()):
                return a, b, rest - b
    return None


def pair_sums(free: np.ndarray) -> np.ndarray:
    """Whether n is the sum of two available lengths."""
    have = (free > 0).astype(np.float64)
    return np.convolve(have, have)[:len(free)] > 0.5


def plan_patterns(counts: dict[int, int], window: int) -> list[tuple[Counter, int]]:
    """[(lengths of a sequence, number of such sequences)] that use every piece once.

    Long combinations help where there are pieces of every length; with few pieces
    they may use up what fits better elsewhere.  So plans with up to three, two, one
    and no exact complements are made until one needs no more sequences than the
    pieces' sum, and the one with the fewest sequences is taken."""
    least = -(-sum(n * k for n, k in counts.items()) // window)
    best: list[tuple[Counter, int]] = []
    for most in (3, 2, 1, 0):
        plan = _patterns(counts, window, most)
        if not best or sum(t for _, t in plan) < sum(t for _, t in best):
            best = plan
        if sum(t for _, t in best) == least:
            break
    return best


def _patterns(counts: dict[int, int], window: int, most: int) -> list[tuple[Counter, int]]:
    """A plan with exact complements of up to ``most`` lengths, then best fit."""
    free = np.zeros(window + 1, np.int64)
    for n, k in counts.items():
        free[n] = k
    patterns: list[tuple[Counter, int]] = []
    pairs = pair_sums(free)
    for length in range(window, 0, -1):
        while free[length]:
            free[length] -= 1  # the piece whose gap is looked up
            found = () if length == window else complement(window - length, length, free, pairs, most)
            free[length] += 1
            if found is None:
                break
            parts = Counter((length, *found))
            times = min(int(free[n]) // k for n, k in parts.items())
            for n, k in parts.items():
                free[n] -= times * k
            patterns.append((parts, times))
            if any(not free[n] for n in parts):
                pairs = pair_sums(free)
    # best fit: open sequences by their gap, [(pattern, number)] each
    open_by_gap: dict[int, list[tuple[Counter, int]]] = {}
    gaps = np.zeros(window + 1, bool)

    def put(gap: int, pattern: Counter, number: int) -> None:
        if gap:
            open_by_gap.setdefault(gap, []).append((pattern, number))
            gaps[gap] = True
        else:
            patterns.append((pattern, number))

    for length in range(window, 0, -1):
        left = int(free[length])
        while left:
            fitting = np.flatnonzero(gaps[length:])
            if len(fitting):
                gap = length + int(fitting[0])
                pattern, number = open_by_gap[gap].pop()
                if not open_by_gap[gap]:
                    del open_by_gap[gap]
                    gaps[gap] = False
                take = min(left, number)
                if take < number:
                    put(gap, pattern, number - take)
                put(gap - length, pattern + Counter((length,)), take)
                left -= take
                continue
            each = window // length
            if left >= each:
                put(window - each * length, Counter({length: each}), left // each)
            if left % each:
                put(window - left % each * length, Counter({length: left % each}), 1)
            left = 0
    return patterns + [p for group in open_by_gap.values() for p in group]


def plan_segments(counts: dict[int, int], window: int) -> list[Segment]:
    """The plan as segments of ranks; patterns take the ranks of a length in turn."""
    used: Counter = Counter()
    out, sequence = [], 0
    for pattern, number in plan_patterns(counts, window):
        offset = 0
        for length in sorted(pattern, reverse=True):
            each = pattern[length]
            out.append(Segment(length, used[length], used[length] + each * number, each, sequence, offset))
            used[length] += each * number
            offset += each * length
        sequence += number
    return out


def pieces(docs: DataFrame, window: int, separator: int, vocabulary: str, id_col: str, text_col: str) -> DataFrame:
    """(id, piece, start, length, ids_crc32, task, nth): the pieces of every document,
    ``nth`` counting pieces of that length within the task."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    mark = np.array([separator], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = byte_vocabulary(vocabulary)
        task = TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        rows: list[tuple] = []

        def full(kind: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*rows))
            rows.clear()
            kinds = (kind, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              names=["id", "piece", "start", "length", "ids_crc32", "task", "nth"])

        for batch in batches:
            kind = batch.schema.field("id").type
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                ids = np.concatenate((words.ids(text.as_py()), mark))
                edges = [0, *range(len(ids) % window or window, len(ids) + 1, window)]
                for k, (a, b) in enumerate(zip(edges, edges[1:])):
                    rows.append((key, k, a, b - a, zlib.crc32(ids[a:b].tobytes()), task, int(seen[b - a])))
                    seen[b - a] += 1
                    if len(rows) >= ROWS:
                        yield full(kind)
            if rows:
                yield full(kind)

    schema = slim.select("id").schema
    for name, kind in (("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()),
                       ("ids_crc32", T.LongType()), ("task", T.IntegerType()), ("nth", T.LongType())):
        schema = schema.add(name, kind)
    return slim.mapInArrow(run, schema)


def pack_best_fit(docs: DataFrame, window: int = 1024, separator: int = 2, vocabulary: str | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of documents packed into few sequences of at most ``window`` ids.

    Columns: id, ``piece`` (from 0), ``start`` (ids of the document before it),
    ``length``, ``ids_crc32``, ``sequence_id``, ``offset`` (gapless from 0).  A
    document is its ids and the separator; one longer than ``window`` is cut
    into pieces of ``window`` ids, the first of which may be shorter.  A null
    text counts as empty: its document is the separator alone.  Null ids and
    repeated rows are packed like any other; other columns are ignored; an
    empty table gives no rows.  Which of several pieces of one length goes
    where follows the order of tasks and rows; it makes no difference to the
    number of sequences.

    Plan: one pass encodes (its pieces are checkpointed, so that nothing is
    encoded twice and a task that runs again can't change the ranks); the
    driver gets one count per length.  Ranks need one prefix sum per length
    over the tasks' counts.
    """
    spark = docs.sparkSession
    cut_up = cut(pieces(docs, window, separator, vocabulary or default_vocabulary(), id_col, text_col))
    by_task = cut_up.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = cut(by_task.select("length", "task", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    counts = {r.length: r.n for r in bases.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= window rows
    plan = plan_segments(counts, window)
    segments = F.broadcast(spark.createDataFrame(  # bounded by the window, not by the table
        [(s.length, s.first, s.last, s.each, s.sequence, s.offset) for s in plan],
        "seg_length long, first long, last long, each long, seq long, off long"))
    ranked = (cut_up.join(bounded_broadcast(bases.drop("n")), ["length", "task"])
              .withColumn("rank", F.col("base") + F.col("nth")))
    here = (F.col("length") == F.col("seg_length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    return ranked.join(segments, here).select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32",
        F.expr("seq + (rank - first) div each").alias("sequence_id"),
        F.expr("off + (rank - first) % each * length").alias("offset"))
