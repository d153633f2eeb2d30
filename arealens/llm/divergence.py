"""Source divergence audit: term stripes per language, folded in the mappers.

* Folding: a partition folds whole documents into hash stripes,
  term -> (documents, occurrences per source), one set of tables per language.
  When they hold ``max_entries`` entries they are written out as rows
  (language, term, documents, [(source, occurrences)]) and start empty again,
  so memory is bounded whatever a partition holds.
* Merging: the partial stripes are dealt and sorted by (language, term) and
  merged as a stream; one stripe is held at a time.  The mappers have reduced
  a very common term to one row per spill before the shuffle.
* Emitting: kept stripes meet the totals of their language's sources and give
  the divergences directly: dense counts of at most ``chunk`` terms by two
  tiles of sources, every pair of sources summed over these terms, and each
  source's ten first terms.  Partial sums and candidates are then merged.
  Nothing grows with the square of a group but the pairs of sources that are
  the result.

Arithmetic is exact (64-bit integers; the share is divided in three steps so
that it stays exact up to 9 * 10**15 occurrences of a language).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arealens.operators.selection import bounded_broadcast

from .common import cut

MAX_ENTRIES = 400_000  # entries that a mapper's stripes hold before they are spilled
LONG = 1 << 22         # bytes of a text folded at a time
CHUNK = 4096           # terms in one block of dense counts
TILE = 200             # sources in a tile, on average
SCALE = 10 ** 9

#: Bytes of terms, A-Z lower-cased; every other byte is a blank.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _terms(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, in lists of bounded length."""
    if len(text) <= LONG:
        yield text.translate(_TERMS).split()
        return
    flat = text.translate(_TERMS)
    start = 0
    while start < len(flat):
        end = start + LONG
        stop = flat.find(b" ", end) if end < len(flat) else len(flat)
        stop = len(flat) if stop < 0 else stop
        yield flat[start:stop].split()
        start = stop


class Stripes:
    """Stripes of one mapper: documents per term, and occurrences per source and term."""

    def __init__(self):
        self.documents: dict[str, Counter] = {}
        self.sources: dict[str, dict[str, Counter]] = {}
        self.entries = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        documents = self.documents.setdefault(lang, Counter())
        counts = self.sources.setdefault(lang, {}).setdefault(source, Counter())
        before = len(documents) + len(counts)
        own: set[bytes] = set()
        for terms in _terms(text):
            counts.update(terms)
            own.update(terms)
        documents.update(own)
        self.entries += len(documents) + len(counts) - before

    def rows(self, size: int = 8192) -> Iterator[pa.RecordBatch]:
        """The stripes as batches; the tables are empty afterwards."""
        for lang, documents in self.documents.items():
            sources = self.sources[lang]
            terms = list(documents)
            for at in range(0, len(terms), size):
                some = terms[at:at + size]
                place, names, numbers = [], [], []
                for source, counts in sources.items():
                    got = np.fromiter(map(counts.__getitem__, some), np.int64, len(some)) \
                        if len(counts) * 4 > len(terms) else \
                        np.fromiter((counts.get(t, 0) for t in some), np.int64, len(some))
                    hit = np.flatnonzero(got)
                    place.append(hit)
                    names.append(np.full(len(hit), len(names), np.int32))
                    numbers.append(got[hit])
                where = np.concatenate(place)
                order = np.argsort(where, kind="stable")
                edges = np.concatenate(([0], np.cumsum(np.bincount(where, minlength=len(some))))).astype(np.int32)
                labels = pa.array(list(sources), pa.string()).take(pa.array(np.concatenate(names)[order]))
                entry = pa.StructArray.from_arrays([labels, pa.array(np.concatenate(numbers)[order])], ["source", "n"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(some)), pa.array(some, pa.binary()).cast(pa.string()),
                     pa.array([documents[t] for t in some], pa.int64()), pa.ListArray.from_arrays(edges, entry)],
                    names=["lang", "term", "documents", "stripe"])
        self.__init__()


STRIPE = "lang string, term string, documents long, stripe array<struct<source: string, n: long>>"


def fold(docs: DataFrame, max_entries: int = MAX_ENTRIES) -> DataFrame:
    """Partial stripes of (lang, source, text) rows: every mapper's, spill by spill."""
    slim = docs.select("lang", "source", F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripes = Stripes()
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c) for c in ("lang", "source", "text"))):
                stripes.add(lang.as_py(), source.as_py(), text.as_py())
                if stripes.entries >= max_entries:
                    yield from stripes.rows()
        yield from stripes.rows()

    return slim.mapInArrow(run, STRIPE)


def _merge_runs(table: pa.Table) -> pa.Table:
    """One row per (lang, term) of a table sorted by them, sources summed."""
    lang, term = table["lang"].combine_chunks(), table["term"].combine_chunks()
    n = len(table)
    new = np.ones(n, bool)
    if n > 1:
        same = pc.and_(pc.equal(lang[1:], lang[:-1]), pc.equal(term[1:], term[:-1]))
        new[1:] = ~same.to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(new)
    if len(starts) == n:
        return table
    run = np.cumsum(new) - 1
    documents = np.add.reduceat(table["documents"].to_numpy(), starts)
    stripe = table["stripe"].combine_chunks()
    entry = stripe.flatten()
    owner = run[pc.list_parent_indices(stripe).to_numpy()]
    merged = pa.table({"run": owner, "source": entry.field("source"), "n": entry.field("n")}) \
        .group_by(["run", "source"]).aggregate([("n", "sum")])
    order = pc.sort_indices(merged, sort_keys=[("run", "ascending")])
    merged = merged.take(order)
    edges = np.concatenate(([0], np.cumsum(np.bincount(merged["run"].to_numpy(), minlength=len(starts))))).astype(np.int32)
    entries = pa.StructArray.from_arrays([merged["source"].combine_chunks().cast(pa.string()),
                                          merged["n_sum"].combine_chunks()], ["source", "n"])
    first = pa.array(starts)
    return pa.table({"lang": lang.take(first), "term": term.take(first), "documents": documents,
                     "stripe": pa.ListArray.from_arrays(edges, entries)})


def merge(partial: DataFrame, least: int) -> DataFrame:
    """Stripes of the terms in at least ``least`` documents of their language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # the last stripe, which later rows may belong to

        def kept(done: pa.Table) -> Iterator[pa.RecordBatch]:
            yield from done.filter(pc.greater_equal(done["documents"], least)).to_batches()

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table.cast(held.schema)])
            table = _merge_runs(table)
            held = table.slice(len(table) - 1)
            yield from kept(table.slice(0, len(table) - 1))
        if held is not None:
            yield from kept(held)

    dealt = partial.repartition("lang", "term").sortWithinPartitions("lang", "term")
    return dealt.mapInArrow(run, STRIPE)


def share(counts: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(10**9 * counts / total), exactly, for counts of at most ``total`` < 9 * 10**15."""
    whole, rest = np.zeros(np.broadcast(counts, total).shape, np.int64), counts
    for _ in range(3):
        rest = rest * 1000
        step = rest // total
        whole = whole * 1000 + step
        rest = rest - step * total
    return whole + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


EMITTED = "lang string, source string, part string, item string, value long"


def _emit(top: int):
    """Cogrouped (stripes, totals of the sources of two tiles) -> partial divergences."""
    def run(key: tuple, stripes: pa.Table, totals: pa.Table) -> pa.Table:
        lang, left, right = (key[i].as_py() for i in range(3))
        tile = totals["tile"].to_numpy()
        names, size = totals["source"].combine_chunks(), totals["total"].to_numpy()
        terms = int(totals["terms"][0].as_py())
        whole = int(totals["lang_total"][0].as_py())
        counts = np.zeros((len(stripes), len(totals)), np.int64)
        if len(stripes):
            stripe = stripes["stripe"].combine_chunks()
            entry = stripe.flatten()
            column = pc.index_in(entry.field("source"), value_set=names).to_numpy()
            counts[pc.list_parent_indices(stripe).to_numpy(), column] = entry.field("n").to_numpy()
        p = np.ascontiguousarray(share(counts + 2, size + 2 * terms).T) if len(stripes) else counts.T
        out_source, out_part, out_item, out_value = [], [], [], []
        ours = np.flatnonzero(tile == left)
        label = names.to_pylist()
        for i in ours.tolist():
            others = np.flatnonzero(tile == right)
            for j in (others[others > i] if left == right else others).tolist():
                out_source.append(label[i])
                out_part.append("pair")
                out_item.append(label[j])
                out_value.append(int(distance(p[i], p[j]).sum()))
        if left == right and len(stripes):
            term = stripes["term"].combine_chunks()
            q = share(stripes["occurrences"].to_numpy() + 2, whole + 2 * terms)
            for i in ours.tolist():
                more = np.flatnonzero((counts[:, i] > 0) & (p[i] > q))
                value = distance(p[i][more], q[more])
                if len(more) > top:  # ties of the last place included
                    keep = value >= np.partition(value, len(value) - top)[len(value) - top]
                    more, value = more[keep], value[keep]
                found = pa.table({"item": term.take(pa.array(more)), "value": value}).sort_by(
                    [("value", "descending"), ("item", "ascending")]).slice(0, top)
                out_source += [label[i]] * len(found)
                out_part += ["term"] * len(found)
                out_item += found["item"].to_pylist()
                out_value += found["value"].to_pylist()
        return pa.table({"lang": pa.array([lang] * len(out_part), pa.string()), "source": pa.array(out_source, pa.string()),
                         "part": pa.array(out_part, pa.string()), "item": pa.array(out_item, pa.string()),
                         "value": pa.array(out_value, pa.int64())})
    return run


def source_divergence(docs: DataFrame, least: int = 10, top: int = 10, lang_col: str = "lang",
                      source_col: str = "source", text_col: str = "text", max_entries: int = MAX_ENTRIES,
                      chunk: int = CHUNK, tile_size: int = TILE) -> DataFrame:
    """How far each source of a language is from the others, and its own terms.

    Columns: lang, source, part, item, value, rank.  Part ``pair``: every other
    source of the language with the summed divergence over the kept terms;
    part ``term``: the first ``top`` kept terms that are more frequent in the
    source than in the language.  Kept are terms in at least ``least``
    documents of the language.  Null text, language and source count as empty;
    repeated rows count as documents of their own; a source without kept terms
    is compared by the constant shares; a language without kept terms gives
    pairs of value 0 and no terms; equal values are ordered by the item's UTF-8
    bytes; other columns are ignored; an empty table gives no rows.

    The kept stripes are checkpointed.  A language's source totals are as many
    rows as it has sources; tiles of about ``tile_size`` of them meet blocks of
    about ``chunk`` terms, so a block is bounded for any number of either.
    """
    slim = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                         for n, c in (("lang", lang_col), ("source", source_col), ("text", text_col))])
    kept = cut(merge(fold(slim, max_entries), least))
    entries = kept.select("lang", "term", F.explode("stripe").alias("e"))
    sums = entries.groupBy("lang", F.col("e.source").alias("source")).agg(F.sum("e.n").alias("total"))
    groups = slim.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").fillna(0, ["total"])
    groups = cut(groups)
    langs = (groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"), F.sum("total").alias("lang_total"))
             .join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms")), "lang", "left").fillna(0, ["terms"]))
    langs = bounded_broadcast(cut(langs.select(
        "*", F.ceil(F.col("sources") / tile_size).cast("int").alias("tiles"),
        F.greatest(F.ceil(F.col("terms") / chunk), F.lit(1)).cast("int").alias("blocks"))))

    def tile_of(source):
        return F.pmod(F.xxhash64(source), F.col("tiles").cast("bigint")).cast("int")

    lefts = F.sequence(F.lit(0), F.col("tiles") - 1)
    pairs = F.flatten(F.transform(lefts, lambda a: F.transform(
        F.sequence(a, F.col("tiles") - 1), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    blocks = (kept.join(langs, "lang")
              .withColumn("occurrences", F.aggregate("stripe", F.lit(0).cast("bigint"), lambda s, e: s + e["n"]))
              .withColumn("pair", F.explode(pairs))
              .select("lang", F.col("pair.a").alias("a"), F.col("pair.b").alias("b"),
                      F.pmod(F.xxhash64("term"), F.col("blocks").cast("bigint")).cast("int").alias("block"),
                      "term", "occurrences",
                      F.filter("stripe", lambda e: tile_of(e["source"]).isin(F.col("pair.a"), F.col("pair.b"))).alias("stripe")))
    totals = (groups.join(langs, "lang").withColumn("tile", tile_of("source")).withColumn("pair", F.explode(pairs))
              .filter(F.col("tile").isin(F.col("pair.a"), F.col("pair.b")))
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("lang", F.col("pair.a").alias("a"), F.col("pair.b").alias("b"), "block",
                      "tile", "source", "total", "terms", "lang_total"))
    key = ["lang", "a", "b", "block"]
    found = cut(blocks.groupBy(*key).cogroup(totals.groupBy(*key)).applyInArrow(_emit(top), EMITTED))
    half = found.filter("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = half.unionByName(half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    pair = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    term = (found.filter("part = 'term'").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("lang", "source", "part", "item", "value", "rank"))
    return pair.unionByName(term)
