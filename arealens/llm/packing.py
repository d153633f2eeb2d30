"""Order-preserving packing of tokenised documents into fixed windows.

Documents are one stream of ids, each followed by a separator.  The stream is
cut into sequences of at most ``window`` ids by dynamic programming over the
candidate cuts (document ends, sentence ends, and dearer ones inside
sentences: a full window after each of those, and steps through long gaps):

    best[j] = min over i of best[i] + padding(j - i) + penalty(j)

``padding(n)`` is ``window - n``, or nothing where ``n`` is a power of two.
The first part depends on i only through ``best[i] + position[i]``, whose
minimum over the sliding window is kept in a monotone queue; the powers of two
are one lookup each.  Every candidate is handled once.

Every Spark partition packs its own rows in their order, in chunks of a
bounded number of ids, so no row is shuffled; a chunk ends where a document
does, or inside one that is longer than a chunk.  A task that runs again
writes the same pieces, since a partition's result depends on its rows alone.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tokens import byte_vocabulary, default_vocabulary

CHUNK = 1 << 18  # ids packed at a time


@lru_cache(maxsize=2)
def _sentence_tables(vocabulary: str) -> tuple[np.ndarray, np.ndarray]:
    """Per id: whether its bytes end a sentence, whether they begin with white space."""
    tokens = byte_vocabulary(vocabulary).token_bytes
    return (np.array([t.endswith((b".", b"!", b"?")) for t in tokens]),
            np.array([t[:1].isspace() for t in tokens]))


def sentence_ends(ids: np.ndarray, vocabulary: str) -> np.ndarray:
    """Places after ids that end a sentence before white space."""
    stop, blank = _sentence_tables(vocabulary)
    return np.flatnonzero(stop[ids[:-1]] & blank[ids[1:]]) + 1


def plan_cuts(at: np.ndarray, penalty: np.ndarray, window: int) -> list[int]:
    """Indices of the chosen cuts, first and last candidate included.

    ``at``: strictly ascending positions from 0, neighbours at most ``window``
    apart; ``penalty``: the price of a cut at each.  Every power of two up to the
    window is planned: the candidates that lie one before another by exactly
    such a length are found for all candidates at once.
    """
    n = len(at)
    sources, targets = [], []
    for p in (1 << k for k in range(window.bit_length()) if 1 << k <= window):
        i = np.searchsorted(at, at - p)
        j = np.flatnonzero((at >= p) & (at[i] == at - p))
        sources.append(i[j])
        targets.append(j)
    target = np.concatenate(targets)
    order = np.argsort(target, kind="stable")
    source = np.concatenate(sources)[order].tolist()
    first = np.searchsorted(target[order], np.arange(n + 1)).tolist()
    position, price = at.tolist(), penalty.tolist()
    best, back = [0.0] * n, [0] * n
    queue: deque[tuple[float, int]] = deque()  # (best + position, index), ascending
    for j in range(1, n):
        here = position[j]
        key = best[j - 1] + position[j - 1]
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j - 1))
        while position[queue[0][1]] < here - window:
            queue.popleft()
        least, i = queue[0]
        least += window - here
        if first[j] < first[j + 1]:
            for k in source[first[j]:first[j + 1]]:
                if best[k] < least:
                    least, i = best[k], k
        best[j], back[j] = least + price[j], i
    cuts = [n - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


def _candidates(ends: list[int], sentences: list[np.ndarray], total: int, window: int,
                sentence_cost: float, inner_cost: float) -> tuple[np.ndarray, np.ndarray]:
    """Cut positions and prices: document ends, sentence ends, and dearer cuts inside sentences
    (one full window after each of those, and steps through long gaps)."""
    soft = np.concatenate(sentences) if sentences else np.zeros(0, np.int64)
    hard = np.array([0, *ends, total], np.int64)
    base = np.unique(np.concatenate((soft, hard)))
    step = max(1, window // 4)
    steps = [np.arange(base[i], base[i + 1], step)[1:] for i in np.flatnonzero(np.diff(base) > step)]
    at = np.unique(np.concatenate([base, base + window, *steps]))
    at = at[at <= total]
    price = np.full(len(at), inner_cost)
    price[np.isin(at, soft)] = sentence_cost
    price[np.isin(at, hard)] = 0.0
    return at, price


def pack(docs: DataFrame, window: int = 1024, separator: int = 0, vocabulary: str | None = None,
         sentence_cost: float = 2.0, inner_cost: float = 12.0, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Pieces of packed documents, one row per piece.

    Columns: id, ``start`` (ids of the document before the piece), ``length``,
    ``ids_crc32``, ``doc_tokens`` (ids of the document with its separator),
    ``sequence_id``, ``offset`` (place in the sequence, gapless from 0), and
    ``ids`` (the ids themselves) if ``with_ids``.  A null text counts as empty:
    its document is one separator.  Null ids and repeated rows are packed like
    any other; other columns are ignored; an empty table gives no rows.  A cut
    at a document end is free, at a sentence end it costs ``sentence_cost``,
    elsewhere ``inner_cost`` ids of padding.
    """
    path = vocabulary or default_vocabulary()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    mark = np.array([separator], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_vocabulary(path)
        sequence = TaskContext.get().partitionId() << 40
        held: list[tuple] = []  # (id, first id's place in the document, ids, all ids of the document)
        ends: list[int] = []
        sentences: list[np.ndarray] = []
        total = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal sequence, total
            at, price = _candidates(ends, sentences, total, window, sentence_cost, inner_cost)
            cuts = at[plan_cuts(at, price, window)].tolist()
            rows, k, here = [], 0, 0
            for key, first, ids, size in held:
                n, done = len(ids), 0
                while done < n:
                    if here >= cuts[k + 1]:
                        k += 1
                    take = min(n - done, cuts[k + 1] - here)
                    part = ids[done:done + take].tobytes()
                    rows.append((key, first + done, take, zlib.crc32(part), size, sequence + k,
                                 here - cuts[k], part))
                    done, here = done + take, here + take
            sequence += len(cuts) - 1
            held.clear(), ends.clear(), sentences.clear()
            total = 0
            for i in range(0, len(rows), 4096):
                columns = list(zip(*rows[i:i + 4096]))
                arrays = [pa.array(columns[0], slim_type)] + [pa.array(c, pa.int64()) for c in columns[1:7]]
                names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
                if with_ids:
                    flat = pa.array(np.frombuffer(b"".join(columns[7]), "<u4").view(np.int32))
                    edges = np.concatenate(([0], np.cumsum(columns[2]))).astype(np.int32)
                    arrays.append(pa.ListArray.from_arrays(pa.array(edges), flat))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            slim_type = batch.schema.field("id").type
            for key, text in zip(batch.column("id"), batch.column("text")):
                key, text = key.as_py(), text.as_py()
                own = encoder.ids(text)
                ids = np.concatenate((own, mark))
                n = len(ids)
                if total and total + n > CHUNK:
                    yield from flush()
                soft = sentence_ends(own, path)
                for first in range(0, n, CHUNK):  # a document longer than a chunk fills several
                    last = min(n, first + CHUNK)
                    held.append((key, first, ids[first:last], n))
                    inside = soft[(soft > first) & (soft < last)] - first
                    sentences.append(inside + total)
                    total += last - first
                    if last < n or total >= CHUNK:
                        yield from flush()
                    else:
                        ends.append(total)
        if total:
            yield from flush()

    schema = slim.select("id").schema.add("start", "long")
    for name in ("length", "ids_crc32", "doc_tokens", "sequence_id", "offset"):
        schema = schema.add(name, "long")
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    return slim.mapInArrow(run, schema).withColumnRenamed("id", id_col)
