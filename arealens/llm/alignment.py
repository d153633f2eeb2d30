"""Cross-tokenizer alignment by inverted pair bitmaps.

Two vocabularies cut a text at different places.  Where tokens of both end at
the same byte, a group closes; every token of one vocabulary is linked with
every token of the other in its group.  An id pair counts in how many
documents it is linked, and documents are scored by these counts.

* Postings: a task numbers its documents in blocks.  Of a block it writes, per
  id pair, a compressed bitmap of the documents that hold the pair linked (a
  sorted list of 16-bit numbers where that is shorter, bits where it is not),
  and multiplicity planes: plane k is the bitmap of the documents whose links
  of the pair, less one, have bit k set.
* Merge: bitmaps of a pair from different blocks hold different documents, so
  merging them adds their popcounts: the documents of a pair, reduced in the
  map tasks before one small shuffle.  The best count of every id of the first
  vocabulary follows from these.
* Return: every posting takes its pair's count back to its documents, a plane
  with the weight of its bit: counts times links, and links of best pairs, are
  sums over the bitmaps, block by block.  Documents are never sent to pairs
  one by one.

Texts are encoded once.  A block is closed at ``block_entries`` (document,
pair) entries or 65,536 documents, so memory is bounded for any table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, new_dir, small
from .tokens import byte_vocabulary, default_pieces, default_vocabulary, piece_vocabulary

BLOCK_ENTRIES = 1 << 21
BLOCK_DOCS = 1 << 16
SLICE = 1 << 20        # links of a long text made at a time
SECOND_BITS = 20       # ids of the second vocabulary are below 2**20
NUMBERS, BITS = 0, 1   # forms of a bitmap
SCORE_ROWS = 1_000_000  # scores are 17 bytes wide, so this bounds a broadcast's bytes
HELD_BLOCKS = 32       # blocks whose sums a task holds


class _Bytes:
    """Bytes of every id of a vocabulary, one behind the other."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array(list(map(len, tokens)), np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)

    def cover(self, ids: np.ndarray, raw: bytes) -> bool:
        """Whether the ids' bytes, joined, are ``raw``."""
        n = self.lengths[ids]
        if int(n.sum()) != len(raw):
            return False
        at = np.repeat(self.starts[ids] - (np.cumsum(n) - n), n) + np.arange(len(raw))
        return self.blob[at].tobytes() == raw


@lru_cache(maxsize=2)
def _tables(first: str, second: str) -> tuple[_Bytes, _Bytes]:
    return _Bytes(byte_vocabulary(first).token_bytes), _Bytes(piece_vocabulary(second).token_bytes)


def encode_both(text: str | None, first: str, second: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Ids of both vocabularies; None where the text has no tokens (null, empty, or not
    covered byte by byte)."""
    if not text:
        return None
    raw = b" " + text.encode()
    a, b = byte_vocabulary(first).ids(" " + text, plain=True), piece_vocabulary(second).ids(text)
    left, right = _tables(first, second)
    return (a, b) if left.cover(a, raw) and right.cover(b, raw) else None


def group_sizes(a_lengths: np.ndarray, b_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of either side in every group, from the tokens' byte lengths."""
    a_ends, b_ends = np.cumsum(a_lengths), np.cumsum(b_lengths)
    shared = a_ends[b_ends[np.searchsorted(b_ends, a_ends)] == a_ends]
    return tuple(np.diff(np.searchsorted(ends, shared, "right"), prepend=0) for ends in (a_ends, b_ends))


def link_pairs(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pair codes, links of each) of one text whose groups hold ``x`` and ``y`` tokens.

    Links are made in slices of whole groups; a single group with more than a
    slice's links goes by its distinct ids.
    """
    links = x * y
    a_from, b_from = np.cumsum(x) - x, np.cumsum(y) - y
    code = a.astype(np.int64) << SECOND_BITS
    found: list[tuple[np.ndarray, np.ndarray]] = []
    big = np.flatnonzero(links > SLICE)
    for g in big.tolist():
        left, n = np.unique(code[a_from[g]:a_from[g] + x[g]], return_counts=True)
        right, m = np.unique(b[b_from[g]:b_from[g] + y[g]].astype(np.int64), return_counts=True)
        found.append(((left[:, None] + right).ravel(), (n[:, None] * m).ravel()))
    rest = np.flatnonzero(links <= SLICE)
    turns = np.cumsum(links[rest]) // SLICE
    for some in np.split(rest, np.flatnonzero(np.diff(turns)) + 1):
        n = links[some]
        of = np.repeat(np.arange(len(some)), n)
        turn = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        width = y[some][of]
        pairs = code[a_from[some][of] + turn // width] + b[b_from[some][of] + turn % width]
        found.append(np.unique(pairs, return_counts=True))
    if len(found) == 1:
        return found[0]
    pairs, place = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
    total = np.zeros(len(pairs), np.int64)
    np.add.at(total, place, np.concatenate([f[1] for f in found]))
    return pairs, total


@lru_cache(maxsize=2)
def _decimals(ids: int) -> np.ndarray:
    """Every id in decimal, followed by each of the three separators, as rows of bytes
    padded with zeros."""
    width = len(str(ids)) + 1
    lines = b"".join(f"{i}{end}".encode().ljust(width, b"\0") for i in range(ids) for end in ",|;")
    return np.frombuffer(lines, np.uint8).reshape(-1, width)


def _digest(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, ids: int) -> str:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3``."""
    start = np.cumsum(x + y) - (x + y)
    last = np.zeros(len(a) + len(b), np.int64)  # 1 after the last first id of a group, 2 after its last second id
    last[start + x - 1], last[start + x + y - 1] = 1, 2
    own = np.ones(len(last), bool)              # places of first ids
    other = np.repeat(start + x - (np.cumsum(y) - y), y) + np.arange(len(b))
    own[other] = False
    code = np.empty(len(last), np.int64)
    code[own], code[other] = a, b
    code = 3 * code + last
    lines, sha = _decimals(ids), hashlib.sha256()
    for at in range(0, len(code), SLICE):
        padded = lines[code[at:at + SLICE]].ravel()
        text = padded[padded > 0]
        sha.update((text[:-1] if at + SLICE >= len(code) else text).tobytes())
    return sha.hexdigest()


class _Block:
    """Postings of the documents of one block."""

    def __init__(self, number: int):
        self.number = number
        self.docs = self.entries = 0
        self.pairs: list[np.ndarray] = []
        self.links: list[np.ndarray] = []

    def add(self, pairs: np.ndarray, links: np.ndarray) -> None:
        self.pairs.append(pairs)
        self.links.append(links)
        self.docs += 1
        self.entries += len(pairs)

    def postings(self) -> Iterator[tuple[np.ndarray, ...]]:
        """(pair, plane, popcount, form, offsets, bytes) of every plane: the bitmaps of all pairs."""
        if not self.entries:
            return
        doc = np.repeat(np.arange(self.docs, dtype=np.uint16), list(map(len, self.pairs)))
        pair = np.concatenate(self.pairs)
        order = np.argsort(pair, kind="stable")  # documents stay ascending within a pair
        pair, doc, more = pair[order], doc[order], np.concatenate(self.links)[order] - 1
        yield self._bitmaps(0, pair, doc)
        plane = 1
        while more.any():
            hit = (more & 1).astype(bool)
            if hit.any():
                yield self._bitmaps(plane, pair[hit], doc[hit])
            left = more > 1
            pair, doc, more, plane = pair[left], doc[left], more[left] >> 1, plane + 1

    def _bitmaps(self, plane: int, pair: np.ndarray, doc: np.ndarray):
        starts = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
        size = np.diff(np.append(starts, len(pair)))
        width = (self.docs + 7) // 8
        dense = 2 * size > width
        form = np.where(dense, BITS, NUMBERS).astype(np.int8)
        numbers = doc[~np.repeat(dense, size)].astype("<u2").tobytes()
        payload = [numbers]
        for s, n in zip(starts[dense].tolist(), size[dense].tolist()):
            bits = np.zeros(width * 8, np.uint8)
            bits[doc[s:s + n]] = 1
            payload.append(np.packbits(bits, bitorder="little").tobytes())
        rank = np.argsort(form, kind="stable")  # lists first, as their bytes lie
        bytes_of = np.where(dense, width, 2 * size)[rank]
        offsets = np.concatenate(([0], np.cumsum(bytes_of)))
        return pair[starts][rank], plane, size[rank], form[rank], offsets, b"".join(payload)


ROW = ("kind integer, block long, ordinal integer, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
       "pair long, plane integer, n long, form integer, bitmap binary")


def _write(docs: DataFrame, first: str, second: str, block_entries: int, id_col: str, text_col: str) -> DataFrame:
    """Document rows (kind 0) and posting rows (kind 1) of one pass over the texts."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = slim.select("id").schema
    fields = [f.split() for f in ROW.split(", ")]
    for name, kind in fields:
        schema = schema.add(name, kind)
    arrow = {"integer": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_length, b_length = (t.lengths for t in _tables(first, second))
        base = TaskContext.get().partitionId() << 32
        block, rows = _Block(base), []

        def table(length: int, /, **columns: pa.Array) -> pa.RecordBatch:
            """A batch with the given columns, the others null."""
            names = ["id"] + [f[0] for f in fields]
            kinds = [kind] + [arrow[f[1]] for f in fields]
            return pa.RecordBatch.from_arrays(
                [columns[c] if c in columns else pa.nulls(length, k) for c, k in zip(names, kinds)], names=names)

        def doc_rows() -> Iterator[pa.RecordBatch]:
            if rows:
                ids, *rest = zip(*rows)
                names = ("block", "ordinal", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
                yield table(len(ids), id=pa.array(ids, kind), kind=pa.array([0] * len(ids), pa.int32()),
                            **{n: pa.array(c, arrow[dict(fields)[n]]) for n, c in zip(names, rest)})
                rows.clear()

        def posting_rows() -> Iterator[pa.RecordBatch]:
            for pair, plane, size, form, offsets, payload in block.postings():
                for at in range(0, len(pair), 1 << 15):
                    end = min(len(pair), at + (1 << 15))
                    n, low = end - at, int(offsets[at])
                    edges = pa.py_buffer((offsets[at:end + 1] - low).astype(np.int32).tobytes())
                    body = pa.py_buffer(payload[low:int(offsets[end])])
                    yield table(n, kind=pa.array(np.ones(n, np.int32)), block=pa.array(np.full(n, block.number)),
                                ordinal=pa.array(np.full(n, block.docs, np.int32)), pair=pa.array(pair[at:end]),
                                plane=pa.array(np.full(n, plane, np.int32)), n=pa.array(size[at:end]),
                                form=pa.array(form[at:end].astype(np.int32)),
                                bitmap=pa.Array.from_buffers(pa.binary(), n, [None, edges, body]))

        for batch in batches:
            kind = batch.schema.field("id").type
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                ids = encode_both(text.as_py(), first, second)
                if ids is None:
                    rows.append((key, block.number, -1, 0, 0, 0, 0, ""))
                else:
                    a, b = ids
                    x, y = group_sizes(a_length[a], b_length[b])
                    rows.append((key, block.number, block.docs, len(a), len(b), len(x), int((x * y).sum()),
                                 _digest(a, b, x, y, max(len(a_length), len(b_length)))))
                    block.add(*link_pairs(a, b, x, y))
                    if block.entries >= block_entries or block.docs >= BLOCK_DOCS:
                        yield from posting_rows()
                        block = _Block(block.number + 1)
                if len(rows) >= 4096:
                    yield from doc_rows()
            yield from doc_rows()
        yield from posting_rows()

    return slim.mapInArrow(run, schema)


def _documents_of(form: np.ndarray, size: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                  body: np.ndarray) -> np.ndarray:
    """Document numbers of some bitmaps, one behind the other."""
    out = np.empty(int(size.sum()), np.int64)
    to = np.cumsum(size)
    listed = np.flatnonzero(form == NUMBERS)
    m = size[listed]
    turn = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
    low = np.repeat(starts[listed], m) + 2 * turn
    out[np.repeat(to[listed] - m, m) + turn] = body[low].astype(np.int64) | body[low + 1].astype(np.int64) << 8
    for i in np.flatnonzero(form == BITS).tolist():
        out[to[i] - size[i]:to[i]] = np.flatnonzero(np.unpackbits(body[starts[i]:ends[i]], bitorder="little"))
    return out


SCORED = "block long, ordinal int, n_best long, count_sum long"


def _return(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the postings per document: links of best pairs, counts times links."""
    held: dict[int, np.ndarray] = {}

    def done() -> Iterator[pa.RecordBatch]:
        for number, sums in held.items():
            hit = np.flatnonzero(sums[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(hit), number)), pa.array(hit.astype(np.int32)),
                 pa.array(sums[0][hit]), pa.array(sums[1][hit])], names=["block", "ordinal", "n_best", "count_sum"])
        held.clear()

    for batch in batches:
        block, docs = batch.column("block").to_numpy(), batch.column("docs").to_numpy()
        size, form = batch.column("n").to_numpy(), batch.column("form").to_numpy()
        weight = np.int64(1) << np.maximum(batch.column("plane").to_numpy().astype(np.int64) - 1, 0)
        count = batch.column("count").to_numpy() * weight
        best = np.where(batch.column("best").to_numpy(zero_copy_only=False), weight, 0)
        bitmap = batch.column("bitmap")
        _, edges, data = bitmap.buffers()
        offsets = np.frombuffer(edges, np.int32)[bitmap.offset:bitmap.offset + len(bitmap) + 1].astype(np.int64)
        body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        order = np.argsort(block, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
            if not len(some):
                continue
            number = int(block[some[0]])
            if number not in held:
                if len(held) >= HELD_BLOCKS:
                    yield from done()
                held[number] = np.zeros((2, int(docs[some[0]])), np.int64)
            doc = _documents_of(form[some], size[some], offsets[some], offsets[some + 1], body)
            np.add.at(held[number][0], doc, np.repeat(best[some], size[some]))
            np.add.at(held[number][1], doc, np.repeat(count[some], size[some]))
    yield from done()


def align(docs: DataFrame, first: str | None = None, second: str | None = None, id_col: str = "doc_id",
          text_col: str = "text", block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_best`` counts links whose pair has the highest count of its first id,
    ties included; ``count_sum`` adds the pair's count over all links.  Null
    and empty texts, and texts whose tokens don't join to a space and the text
    (such as texts with U+2581), have zeros and an empty digest.  Special
    tokens' strings are plain text.  Null ids and repeated rows are rows like
    any other (a repeated text counts every time); other columns are ignored;
    an empty table gives no rows.

    The rows of the one pass over the texts are written to the shared folder;
    counting, scoring and the return read them there.
    """
    spark = docs.sparkSession
    path = new_dir(spark, "alignment")
    rows = _write(docs, first or default_vocabulary(), second or default_pieces(), block_entries, id_col, text_col)
    rows.write.parquet(path)
    every = spark.read.schema(rows.schema).parquet(path)
    postings = every.filter("kind = 1").select("block", F.col("ordinal").alias("docs"), "pair", "plane", "n",
                                               "form", "bitmap")
    counts = cut(postings.filter("plane = 0").groupBy("pair").agg(F.sum("n").alias("count")))
    first_id = F.shiftright("pair", SECOND_BITS).alias("a")
    tops = counts.groupBy(first_id).agg(F.max("count").alias("top"))
    scores = cut(counts.select("pair", "count", first_id).join(tops, "a")
                 .select("pair", "count", (F.col("count") == F.col("top")).alias("best")))
    scored = (postings.join(small(scores, SCORE_ROWS), "pair")
              .select("block", "docs", "plane", "n", "form", "bitmap", "count", "best").mapInArrow(_return, SCORED))
    sums = scored.groupBy("block", "ordinal").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    documents = every.filter("kind = 0").select("id", "block", "ordinal", "n_a", "n_b", "n_groups", "n_links",
                                                "groups_sha256")
    zero = F.lit(0).cast("bigint")
    return documents.join(sums, ["block", "ordinal"], "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
