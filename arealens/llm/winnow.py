"""Benchmark decontamination by winnowing, in DataFrame functions only.

A *window* is ``span`` consecutive words of a benchmark item (an item with
fewer words, but not none, is one window).  For windows of ``m`` words,
``k = min(k_words, m)`` and every run of ``w = m - k + 1`` consecutive k-gram
hashes lies inside one window, so keeping the minimum hash of each such run on
both sides means that every shared window shares a kept hash: documents
without a common fingerprint can't hold a window.

1. Documents and items are reduced to their kept hashes; the fingerprint join
   finds the candidate documents (one pass over the texts).
2. In candidate documents hits are extended to whole windows: 128-bit
   signatures of all windows there are joined with those of the items.
3. Covered words are counted as a union of intervals (a running maximum of
   window ends), items as distinct ids; never one row per pair of documents.

Results depend on the text only, so copies are worked out once per text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ascii_lower, cut, let, small, text_key

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows up to which a benchmark-side table, after counting, is broadcast.
BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    """Lower-cased (A-Z) words; null has none."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS, -1)
    return F.filter(parts, lambda x: x != "")


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda x: F.xxhash64(x))


_NONE = "array<bigint>"


def _grams(hashes: Column, k: int) -> Column:
    """Hash of every run of ``k`` word hashes (``hashes``: a bound variable)."""
    return F.when(F.size(hashes) >= k, F.transform(
        F.sequence(F.lit(1), F.size(hashes) - (k - 1)), lambda i: F.xxhash64(F.slice(hashes, i, k)))
    ).otherwise(F.array().cast(_NONE))


def _kept(grams: Column, w: int) -> Column:
    """Distinct minima over each ``w`` consecutive hashes (``grams``: a bound variable)."""
    return F.when(F.size(grams) >= w, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size(grams) - (w - 1)),
        lambda i: F.array_min(F.slice(grams, i, w))))).otherwise(F.array().cast(_NONE))


def _fingerprints(hashes: Column, lengths: list[int], k_words: int) -> Column:
    """(m, f): kept hashes for windows of each length (``hashes``: a bound variable)."""
    def of(m: int) -> Column:
        k = min(k_words, m)
        kept = let(_grams(hashes, k), lambda g: _kept(g, m - k + 1))
        return F.transform(kept, lambda x: F.struct(F.lit(m).alias("m"), x.alias("f")))

    return F.concat(*[of(m) for m in lengths])


def _windows(hashes: Column, lengths: list[int]) -> Column:
    """(at, m, a, b): start, words and 128-bit signature of every window."""
    def of(m: int) -> Column:
        return F.when(F.size(hashes) >= m, F.transform(
            F.sequence(F.lit(1), F.size(hashes) - (m - 1)),
            lambda i: let(F.slice(hashes, i, m), lambda part: F.struct(
                i.alias("at"), F.lit(m).alias("m"), F.xxhash64(part).alias("a"),
                F.xxhash64(F.lit(m), part).alias("b"))))
        ).otherwise(F.array().cast("array<struct<at:int,m:int,a:bigint,b:bigint>>"))

    return F.concat(*[of(m) for m in lengths])


def _per_text(docs: DataFrame, benchmark: DataFrame, span: int, k_words: int, id_col: str,
              text_col: str, item_col: str, item_text_col: str) -> tuple[DataFrame, DataFrame] | None:
    """(rows, texts): one row per id and text with its words and copies, and the
    hits of each text that has any; None where no item has a word."""
    items = cut(benchmark.select(F.col(item_col).cast("string").alias("item"),
                                 word_hashes(F.col(item_text_col)).alias("h"))
                .withColumn("n", F.size("h")).filter("n > 0 and item is not null")
                .withColumn("m", F.least("n", F.lit(span))))
    lengths = sorted(r[0] for r in items.select("m").distinct().collect())  # at most `span` values
    if not lengths:
        return None
    slim = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"),
                       F.col(text_col).alias("text"))

    def of_item(make) -> DataFrame:
        """Item side: each item only with its own window length."""
        def part(m: int) -> DataFrame:
            made = let(F.col("h"), lambda h: make(h, [m]))
            return items.filter(F.col("m") == m).select("item", F.explode(made).alias("x")).select("item", "x.*")

        return reduce(DataFrame.unionByName, map(part, lengths))

    prints = cut(of_item(lambda h, own: _fingerprints(h, own, k_words)).select("m", "f").distinct())
    rows = (slim.select("id", "key", let(word_hashes(F.col("text")), lambda h: F.struct(
        F.size(h).alias("n"), _fingerprints(h, lengths, k_words).alias("prints"))).alias("x"))
        .select("id", "key", F.col("x.n").alias("n"), F.posexplode_outer("x.prints").alias("at", "p"))
        .select("id", "key", "n", "at", "p.*"))
    found = rows.join(small(prints.withColumn("hit", F.lit(True)), BROADCAST_ROWS), ["m", "f"], "left")
    # one row per document and text: its words, how often it occurs, whether a fingerprint met
    base = cut(found.groupBy("id", "key", "n").agg(
        F.sum((F.coalesce("at", F.lit(0)) == 0).cast("long")).alias("copies"),
        F.coalesce(F.max("hit"), F.lit(False)).alias("hit")))

    wanted = cut(base.filter("hit").select("key").distinct())
    texts = (slim.join(small(wanted, BROADCAST_ROWS), "key", "left_semi")
             .select("key", "text").dropDuplicates(["key"]))
    in_texts = (texts.select("key", F.explode(let(
        word_hashes(F.col("text")), lambda h: _windows(h, lengths))).alias("x")).select("key", "x.*"))
    item_windows = cut(of_item(_windows).select("item", "m", "a", "b").distinct())
    known = cut(item_windows.select("m", "a", "b").distinct())
    hits = cut(in_texts.join(small(known, BROADCAST_ROWS), ["m", "a", "b"], "left_semi"))

    ends = F.col("at") + F.col("m")
    before = F.max(ends).over(W.partitionBy("key").orderBy("at", "m")
                              .rowsBetween(W.unboundedPreceding, -1))
    covered = (hits.select("key", "at", ends.alias("end"), before.alias("before"))
               .groupBy("key").agg(F.sum(F.greatest(
                   F.lit(0), F.col("end") - F.greatest("at", F.coalesce("before", F.lit(0)))))
                   .cast("long").alias("n_hit")))
    named = (hits.select("key", "m", "a", "b").distinct()
             .join(small(item_windows, BROADCAST_ROWS), ["m", "a", "b"])
             .groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items")))
    per_text = cut(covered.join(named, "key"))
    return base, per_text


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = 10, k_words: int = 5,
                  id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Words of each document that lie in a window of a benchmark item.

    One row per document row: id, ``n_words``, ``n_hit`` (words inside any
    occurrence of a window), ``n_items`` (items with an occurring window),
    ``items`` (their ids as sorted strings), ``contaminated``.  Null or empty
    texts have no words; null ids are kept as documents and ignored as items;
    repeated rows are repeated in the result; other columns are ignored; empty
    tables give zero hits or no rows.
    """
    found = _per_text(docs, benchmark, span, k_words, id_col, text_col, item_col, item_text_col)
    if found is None:
        return docs.select(F.col(id_col), F.size(words(F.col(text_col))).cast("long").alias("n_words"),
                           F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"),
                           F.array().cast("array<string>").alias("items"),
                           F.lit(False).alias("contaminated"))
    base, per_text = found
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return (base.join(small(per_text, BROADCAST_ROWS // 4), "key", "left")
            .select("*", copies.alias("__copy"))
            .select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_words"),
                    F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, span: int = 10, k_words: int = 5,
                      id_col: str = "doc_id", text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text holds a window of an item; same columns."""
    found = _per_text(docs, benchmark, span, k_words, id_col, text_col, item_col, item_text_col)
    if found is None:
        return docs
    return (docs.withColumn("__key", text_key(F.col(text_col)))
            .join(small(found[1].select(F.col("key").alias("__key")), BROADCAST_ROWS), "__key", "left_anti")
            .select(*docs.columns))
