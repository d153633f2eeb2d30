"""Exact removal of repeated byte strings by column-wise suffix ordering.

Every byte covered by a ``width``-byte string that starts anywhere else goes.

Inserting one symbol per document each round over whole documents takes as
many rounds as the longest text has bytes, each rewriting everything inserted
so far.  So the documents are first cut into short aligned *reads* in which
the rounds are bounded, without losing a match:

1. Each ``width``-byte window is named by its smallest ``gram``-byte hash
   (winnowing).  Equal windows have the same name at the same place, so the
   windows that share one occurrence of a name form a read of less than twice
   the width, and only reads with one name can hold equal windows.
2. Reads equal as a whole are repeats without further work; reads whose name
   occurs once are not repeats.
3. The others are cut at fixed places around the name, dealt by the bytes that
   all windows of such a part share, and every shard of parts is ordered
   column by column: each round puts one more symbol in front of every part
   and updates the order and the common prefixes in one sequential pass.  A
   window is a repeat where its common prefix with a neighbour reaches
   ``width``.  A group of parts too large for a shard is counted by whole
   windows instead.

Every step between is a Spark table in shuffle files or the shared folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, text_key

PIECE = 1 << 20  # bytes worked on at a time; places within fit 20 bits
SHARD = 1 << 15  # parts ordered in one go
BROADCAST_BYTES = 16 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER = _powers(_BASE, PIECE + 1)
_BACK = _powers(_INVERSE, PIECE + 1)


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours, by block-wise running minima."""
    n = len(x) - w + 1
    pad = -len(x) % w
    blocks = np.concatenate((x, np.full(pad, np.uint64(2**64 - 1)))).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1:w - 1 + n])


def reads_of(data: np.ndarray, ends: np.ndarray, width: int, gram: int):
    """(name hash, name's place, first window, last window) of the reads of some texts.

    ``data``: at most ``PIECE`` bytes, texts one after the other; ``ends``:
    where each ends.  Places are those in ``data``.
    """
    n, w = len(data), width - gram + 1
    none = np.zeros(0, np.int64)
    if n < width:
        return none.astype(np.uint64), none, none, none
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(data * _POWER[:n], dtype=np.uint64)))
    h = (sums[gram:] - sums[:-gram]) * _BACK[:n - gram + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    low = np.uint64(PIECE - 1)
    at = (_sliding_min((h & ~low) | np.arange(len(h), dtype=np.uint64), w) & low).astype(np.int64)
    starts = np.concatenate(([0], ends[:-1]))
    inside = np.zeros(n + 1, np.int32)  # window starts that stay within their text
    long = ends - starts >= width
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - width + 1, -1)
    ok = np.cumsum(inside)[:len(at)] > 0
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | ~ok[:-1]
    new[starts[starts < len(at)]] = True
    first = np.flatnonzero(new & ok)
    last = np.flatnonzero(ok & np.concatenate((new[1:] | ~ok[1:], [True])))
    place = at[first]
    return h[place], place, first, last


def _groups(texts: list[bytes], width: int) -> Iterator[tuple[list[int], list[int], bytes]]:
    """(text numbers, their places in the text, bytes) of pieces of bounded size.

    A text longer than a piece comes in several, overlapping by ``width - 1``.
    """
    who, where, parts, size = [], [], [], 0
    for i, text in enumerate(texts):
        step = PIECE - width + 1
        for a in range(0, max(1, len(text) - width + 1), step):
            part = text[a:a + PIECE]
            if size + len(part) > PIECE:
                yield who, where, parts
                who, where, parts, size = [], [], [], 0
            who.append(i), where.append(a), parts.append(part)
            size += len(part)
    if parts:
        yield who, where, parts


def all_reads(texts: list[bytes], width: int, gram: int, named_only: bool = False):
    """Per piece: (bytes, text numbers, shifts, names, class hashes, places, firsts, lasts).

    ``shifts`` added to a place in the piece give the place in the text.  The
    class hash is of the read's bytes and its name's place in them.
    """
    for who, where, parts in _groups(texts, width):
        data = b"".join(parts)
        ends = np.cumsum([len(p) for p in parts])
        name, place, first, last = reads_of(np.frombuffer(data, np.uint8), ends, width, gram)
        if not len(first):
            continue
        if named_only:
            yield data, None, None, name, None, place, first, last
            continue
        piece = np.searchsorted(ends, first, side="right")
        shift = np.array(where)[piece] - np.concatenate(([0], ends[:-1]))[piece]
        digest = xxhash.xxh3_64_digest
        raw = b"".join([digest(data[a:b], s) for a, b, s in
                        zip(first.tolist(), (last + width).tolist(), (place - first).tolist())])
        yield data, np.array(who)[piece], shift, name, np.frombuffer(raw, ">u8").astype(np.uint64), place, first, last


def repeated_starts(parts: list[bytes], first: np.ndarray, width: int, columns: int) -> np.ndarray:
    """Which windows of aligned parts occur in more than one of them.

    Part i has its bytes from column ``first[i]`` on; the result is a boolean
    matrix of part and window start column.  From the last column to the
    first, a stable sort by the symbol put in front keeps the parts in suffix
    order; the common prefix of new neighbours is one more than the least
    prefix between their old places.
    """
    m = len(parts)
    lengths = np.fromiter(map(len, parts), np.int64, m)
    symbols = np.full((m, columns), 256, np.int16)  # 256: no symbol
    row = np.repeat(np.arange(m), lengths)
    column = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(first, lengths)
    symbols[row, column] = np.frombuffer(b"".join(parts), np.uint8)
    symbols = np.ascontiguousarray(symbols.T)
    out = np.zeros((m, columns - width + 1), bool)
    order, common = np.arange(m), np.zeros(m, np.int16)  # common[i]: with the part before
    levels = max(1, int(m).bit_length())
    least = np.zeros((levels, m), np.int16)
    for x in range(columns - 1, -1, -1):
        least[0] = common
        for k in range(1, levels):  # least over 2**k neighbours
            half = 1 << (k - 1)
            least[k] = least[k - 1]
            np.minimum(least[k - 1][:m - half], least[k - 1][half:], out=least[k][:m - half])
        front = symbols[x][order]
        moved = np.argsort(front, kind="stable")
        front = front[moved]
        i, j = moved[:-1], moved[1:]
        same = (front[1:] == front[:-1]) & (front[1:] != 256)
        i, j = i[same], j[same]
        k = np.frexp((j - i).astype(np.float64))[1] - 1
        common = np.zeros(m, np.int16)
        common[1:][same] = 1 + np.minimum(least[k, i + 1], least[k, j - (1 << k) + 1])
        order = order[moved]
        if x <= columns - width:
            hit = np.flatnonzero(common >= width)
            out[order[hit], x] = True
            out[order[hit - 1], x] = True
    return out


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist()))


def _bounded(df: DataFrame, size: int) -> DataFrame:
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def repeated_spans(docs: DataFrame, width: int = 200, gram: int = 56, step: int = 36,
                   shard: int = SHARD, text_col: str = "text") -> DataFrame:
    """(key, spans): byte ranges of repeated ``width``-byte strings of every text that has any.

    ``key`` is the 128-bit digest of the text, ``spans`` disjoint (start, stop) in order.
    """
    slim = docs.select(text_key(F.col(text_col)).alias("key"), F.col(text_col).cast("binary").alias("text")).filter(F.octet_length("text") >= width)

    def find(named_only: bool) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = batch.column("key")
                for _, who, shift, name, digest, place, first, last in all_reads(
                        batch.column("text").to_pylist(), width, gram, named_only):
                    columns = [pa.array(name.view(np.int64))]
                    if not named_only:
                        columns += [pa.array(digest.view(np.int64)), keys.take(pa.array(who)),
                                    pa.array(((first + shift) << 32) | (last + shift))]
                    yield pa.RecordBatch.from_arrays(columns, names=["name", "cls", "key", "span"][:len(columns)])

        return run

    # Most names occur once; their reads are never written.
    names = cut(slim.mapInArrow(find(True), "name long").groupBy("name").agg(F.count(F.lit(1)).alias("n"))
                .filter("n > 1").select("name"))
    reads = cut(slim.mapInArrow(find(False), "name long, cls long, key binary, span long")
                .join(_bounded(names, 16 * names.count()), "name"))
    classes = cut(reads.groupBy("name", "cls").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("key")))
    several = classes.groupBy("name").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).filter(
        "k > 1 and least = 1").select("name")
    open_ = classes.join(several, "name", "left_semi")
    once, twice_or_more = F.when(F.col("n") == 1, F.col("cls")), F.when(F.col("n") > 1, F.col("cls"))
    wanted = cut(open_.groupBy("key").agg(F.collect_list(once).alias("once"),
                                          F.collect_list(twice_or_more).alias("more")))
    size = wanted.agg(F.sum((F.size("once") + F.size("more")) * 8 + 64)).first()[0] or 0
    sources = slim.join(_bounded(wanted, size), "key").dropDuplicates(["key"]).select("text", "once", "more")

    def cut_reads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                want = dict.fromkeys(batch.column("once")[i].as_py(), 1)
                want.update(dict.fromkeys(batch.column("more")[i].as_py(), 2))
                rows: list[tuple] = []
                for data, _, _, name, digest, place, first, last in all_reads(
                        [batch.column("text")[i].as_py()], width, gram):
                    for g, c, p, a, b in zip(name.view(np.int64).tolist(), digest.view(np.int64).tolist(),
                                             place.tolist(), first.tolist(), last.tolist()):
                        n = want.pop(c, 0)
                        if not n:
                            continue
                        # windows start p - b to p - a bytes before the name
                        for o in range((p - b) // step * step, p - a + 1, step):
                            far = o + step - 1
                            near, back = max(o, p - b), min(far, p - a)
                            core = xxhash.xxh3_64_intdigest(data[p - o:p - far + width], o) - (1 << 63)
                            rows.append((core, g, c, n, far - back, p - a - far, data[p - back:p - near + width]))
                if rows:
                    columns = list(zip(*rows))
                    types = [pa.int64()] * 6 + [pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)],
                                                     names=["core", "name", "cls", "n", "col", "base", "bytes"])

    parts = cut(sources.mapInArrow(
        cut_reads, "core long, name long, cls long, n long, col long, base long, bytes binary"))
    groups = cut(parts.groupBy("core").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).filter(
        "k > 1 and least = 1").select("core", "k"))
    usual_parts = parts.join(groups.filter(F.col("k") <= shard).select("core"), "core", "left_semi")
    large = groups.filter(F.col("k") > shard).select("core")
    shards = max(1, -(-(groups.agg(F.sum("k")).first()[0] or 0) // (shard // 2)))
    columns = width + step - 1

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            flags = repeated_starts(t.column("bytes").to_pylist(), t.column("col").to_numpy(), width, columns)
            rows = []
            single = t.column("n").to_numpy() == 1
            names, cls, base = (t.column(x).to_numpy() for x in ("name", "cls", "base"))
            for i in np.flatnonzero(flags.any(axis=1) & single):
                rows += [(names[i], cls[i], base[i] + a, base[i] + b) for a, b in _runs(flags[i])]
            out = np.array(rows, np.int64).reshape(-1, 4).T
            return pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["name", "cls", "a", "b"])

        # parts arrive by core: a shard ends between two cores, so it stays near its bound
        held, size, final = [], 0, None
        for batch in batches:
            core = batch.column("core").to_numpy()
            begin = 0
            for edge in [*(np.flatnonzero(np.diff(core)) + 1).tolist(), len(core)]:
                if size >= shard and core[begin] != final:
                    yield flush(held)
                    held, size = [], 0
                held.append(batch.slice(begin, edge - begin))
                size += edge - begin
                final, begin = core[edge - 1], edge
        if held:
            yield flush(held)

    usual = (usual_parts.repartition(shards, "core").sortWithinPartitions("core")
             .mapInArrow(order, "name long, cls long, a long, b long"))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                text = row["bytes"]
                n = len(text) - width + 1
                hashes = [xxhash.xxh3_128_digest(text[i:i + width]) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes, pa.binary()), *[pa.array(np.full(n, row[x])) for x in ("name", "cls", "n")],
                     pa.array(row["base"] + row["col"] + np.arange(n))], names=["w", "name", "cls", "n", "a"])

    each = parts.join(large, "core", "left_semi").mapInArrow(windows, "w binary, name long, cls long, n long, a long")
    twice = each.groupBy("w").agg(F.sum("n").alias("times")).filter("times > 1").select("w")
    counted = (each.filter("n = 1").join(twice, "w", "left_semi")
               .select("name", "cls", "a", F.col("a").alias("b")))
    partial = usual if large.isEmpty() else usual.unionByName(counted)
    found = cut(classes.filter("n > 1").select("name", "cls", F.lit(None).cast("long").alias("a"),
                                               F.lit(None).cast("long").alias("b")).unionByName(partial))
    first, last = F.shiftright("span", 32), F.col("span").bitwiseAND((1 << 32) - 1)
    spans = (reads.join(found, ["name", "cls"]).select(
        "key", F.coalesce(first + F.col("a"), first).alias("start"),
        (F.coalesce(first + F.col("b"), last) + width).alias("stop")).distinct()
        .groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans")))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            merged = []
            for spans in batch.column("spans").to_pylist():
                out: list[list[int]] = []
                for s in spans:
                    if out and s["start"] <= out[-1][1]:
                        out[-1][1] = max(out[-1][1], s["stop"])
                    else:
                        out.append([s["start"], s["stop"]])
                merged.append([{"start": a, "stop": b} for a, b in out])
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(
                merged, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))], names=["key", "spans"])

    return spans.mapInArrow(merge, "key binary, spans array<struct<start:long,stop:long>>")


def remove_repeats(docs: DataFrame, width: int = 200, id_col: str = "doc_id", text_col: str = "text",
                   shard: int = SHARD) -> DataFrame:
    """One row per document row: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (bytes), ``kept_sha256``.

    Texts count as UTF-8 bytes, null as empty; matches never cross documents
    and are judged on the input.  Null ids and repeated rows are kept (equal
    texts of ``width`` bytes or more lose everything); other columns are
    ignored; an empty table gives no rows.
    """
    spans = cut(repeated_spans(docs, width, shard=shard, text_col=text_col))
    size = spans.agg(F.sum(F.size("spans") * 24 + 32)).first()[0] or 0
    slim = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    joined = slim.join(_bounded(spans, size), "key", "left").select("id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 512):
                part = batch.slice(i, 512)
                rows = []
                for text, spans in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                    kept, at, gone = [], 0, 0
                    for s in spans or ():
                        kept.append(text[at:s["start"]])
                        gone, at = gone + s["stop"] - s["start"], s["stop"]
                    kept = b"".join([*kept, text[at:]])
                    rows.append((len(text), gone, len(spans or ()), kept, hashlib.sha256(kept).hexdigest()))
                columns = list(zip(*rows))
                types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *[pa.array(c, t) for c, t in zip(columns, types)]],
                    names=["id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    schema = (slim.select("id").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long")
              .add("kept", "binary").add("kept_sha256", "string"))
    return joined.mapInArrow(run, schema).withColumnRenamed("id", id_col)
