"""Language identification by nearest centroids of TF-IDF character n-grams.

* Features: hashed counts of 1- to 3-grams of the lower-cased letters, words
  separated by one blank; ``(1 + log tf) * idf``, scaled to unit length.
* Model: the labelled sample's vectors of each language are clustered into
  several centroids (spherical k-means); it is a small table whatever the
  number of documents.
* Prediction: the language of the centroid with the largest cosine.  A text
  is *rejected* where its cosine lies far below what texts of its length
  reached in the sample (distance-based rejection) or is no larger than letters
  drawn at random reach at that length, or where it has no letter.

Whole texts are read: counts add up over pieces of bounded size.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 12
PIECE = 1 << 18  # characters counted at a time
_SALTS = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))
UNKNOWN = "und"
LOW = 0.01  # quantile of the sample's cosines that stands for the least of a length class
LEAST_ROWS = 100  # sampled rows for that; a class with fewer borrows its neighbours'
CHANCE = 1.1  # above what letters at random reach
_AT_RANDOM = ("abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyz" * 2 + "0123456789+/",
              "".join(map(chr, range(0x430, 0x450))), "".join(map(chr, range(0x4e00, 0x6e00))))


def counts(text: str | None) -> tuple[np.ndarray, int]:
    """Hashed n-gram counts of a text, and its number of letters."""
    out, letters = np.zeros(BUCKETS, np.int64), 0
    for i in range(0, len(text or ""), PIECE):
        # two characters of overlap, so that no n-gram is lost between pieces
        piece = "".join([c if c.isalpha() else " " for c in text[max(0, i - 2):i + PIECE].lower()]) \
            if not text.isascii() else text[max(0, i - 2):i + PIECE].lower().translate(_ASCII)
        line = " " + " ".join(piece.split()) + " "
        codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
        blank = codes == 32
        letters += int(len(codes) - blank.sum())
        one = codes * _SALTS[0]
        two = (one[:-1] ^ (codes[1:] * _SALTS[1])) * _SALTS[2]
        three = (two[:-1] ^ (codes[2:] * _SALTS[0])) * _SALTS[1]
        grams = np.concatenate((one[~blank], two, three[~blank[1:-1]])) >> np.uint32(20)
        out += np.bincount(grams, minlength=BUCKETS)
    return out, letters


_ASCII = {i: chr(i) if chr(i).isalpha() else " " for i in range(128)}


def weigh(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vectors of rows of counts (a row without counts stays zero)."""
    x = np.where(tf > 0, 1 + np.log(np.maximum(tf, 1)), 0).astype(np.float32) * idf
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


@dataclass
class Model:
    langs: list[str]  # of each centroid
    centroids: np.ndarray  # unit rows
    idf: np.ndarray
    floor: np.ndarray  # least cosine accepted, by the bit length of the number of letters


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; fewer rows than ``k`` are their own centroids."""
    if len(x) <= k:
        return x
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        sums = np.stack([x[near == j].sum(axis=0) if (near == j).any() else c[j] for j in range(k)])
        c = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return c


def chance(centroids: np.ndarray, idf: np.ndarray, seed: int, top: int = 16) -> np.ndarray:
    """Largest cosine of words of letters drawn at random, by the bit length of the number
    of letters (from ``top`` on it hardly grows)."""
    draw, out = random.Random(seed), np.zeros(64)
    for b in range(1, top + 1):
        found = []
        for letters in _AT_RANDOM:
            for _ in range(8 if b < 10 else 2):
                line = "".join(draw.choices(letters, k=(1 << b) - 1))
                found.append(counts(" ".join(line[i:i + 6] for i in range(0, len(line), 6)))[0])
        out[b:] = max(out[b - 1], (weigh(np.stack(found), idf) @ centroids.T).max())
    return out


def floors(best: np.ndarray, letters: np.ndarray, by_chance: np.ndarray, slack: float) -> np.ndarray:
    """Least cosine accepted, by the bit length of the number of letters.

    ``slack`` times a low quantile of the sample's cosines at that length (and the
    lengths nearest to it, until these are enough rows), and at least somewhat above
    chance, but never above that quantile.  A sample too small for a quantile at any
    length leaves chance.
    """
    bits, floor = np.array([int(n).bit_length() for n in letters]), np.zeros(64)
    for b in range(64):
        reach = 1
        while (near := np.abs(bits - b) <= reach).sum() < LEAST_ROWS and reach < 64:
            reach += 1
        low = np.quantile(best[near], LOW)
        floor[b] = min(low, max(CHANCE * by_chance[b], slack * low if near.sum() >= LEAST_ROWS else 0.0))
    return floor


def fit(labelled: DataFrame, per_language: int = 600, per_class: int = 4, max_languages: int = 200,
        sample_rows: int = 12_000, slack: float = 0.5, seed: int = 5, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> Model | None:
    """Fit on a bounded sample: about ``per_language`` rows of each language,
    those with the smallest hash of text (so copies don't count twice as much
    as their rows do, and the choice doesn't depend on partitions).  With many
    languages it is fewer of each, so that the driver gets at most about twice
    ``sample_rows`` rows of 8 KB.

    Rows with a null language or text are ignored; without any labelled row
    the model is None.  More than ``max_languages`` labels raise ValueError.
    """
    own = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                          F.col(lang_col).alias("lang")).filter("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in own.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
             .limit(max_languages + 1).collect()}
    if not sizes:
        return None
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    per_language = max(1, min(per_language, sample_rows // len(sizes)))
    wanted: Column = F.lit(False)
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30))
    for lang, n in sizes.items():
        share = min(1.0, max(2 * per_language, 40) / n)
        wanted = wanted | ((F.col("lang") == lang) & (draw < F.lit(int(share * (1 << 30)))))
    sample = own.filter(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [counts(t) for t in batch.column("text").to_pylist()]
            tf = [np.minimum(c, 65535).astype("<u2").tobytes() for c, _ in got]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("draw"), pa.array(tf, pa.binary()),
                 pa.array([n for _, n in got], pa.int64())], names=["lang", "draw", "tf", "letters"])

    # About twice the sample is drawn by hash, and the first of each language are kept.
    rows = sorted(
        ((r["lang"], r["draw"], bytes(r["tf"]), r["letters"]) for r in
         sample.select("text", "lang", draw.alias("draw")).mapInArrow(
             run, "lang string, draw long, tf binary, letters long").filter("letters > 0").toLocalIterator()),
        key=lambda r: (r[0], r[1], r[2]))
    taken, seen = [], {}
    for r in rows:
        seen[r[0]] = seen.get(r[0], 0) + 1
        if seen[r[0]] <= per_language:
            taken.append(r)
    if not taken:
        return None
    tf = np.stack([np.frombuffer(r[2], "<u2") for r in taken])
    names, letters = np.array([r[0] for r in taken], object), np.array([r[3] for r in taken])
    idf = (np.log((1 + len(tf)) / (1 + (tf > 0).sum(axis=0))) + 0.1).astype(np.float32)
    x = weigh(tf, idf)
    # short texts have few n-grams: centroids come from the longer half of the sample
    rng = np.random.default_rng(seed)
    langs, parts = [], []
    for lang in sorted(set(names)):
        mine = names == lang
        long = mine & (letters >= np.median(letters[mine]))
        c = _kmeans(x[long], per_class, rng)
        langs += [lang] * len(c)
        parts.append(c)
    centroids = np.concatenate(parts).astype(np.float32)
    best = (x @ centroids.T).max(axis=1)
    floor = floors(best, letters, chance(centroids, idf, seed), slack)
    return Model(langs, centroids, idf, floor)


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
            carry: list[str] | None = None) -> DataFrame:
    """One row per document row: id, ``carry`` columns, ``lang_pred``, ``score`` (cosine), ``rejected``.

    A null text, one without letters, or any text without a model is ``und``
    with score 0, rejected.  A rejected text with letters keeps its nearest
    language in ``lang_pred``.  Ties go to the first language by name; null
    ids and repeated rows are kept; other columns are ignored.
    """
    carry = carry or []
    names = [f"c{i}" for i in range(len(carry) + 1)]
    # a carried text travels once
    column = names[1 + carry.index(text_col)] if text_col in carry else "text"
    slim = docs.select(*[F.col(c).alias(n) for c, n in zip([id_col, *carry], names)],
                       *([] if text_col in carry else [F.col(text_col).alias("text")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(column)
            for i in range(0, len(texts), 256):
                part = batch.slice(i, 256)
                got = [counts(t) for t in part.column(column).to_pylist()]
                letters = np.array([n for _, n in got])
                lang, score = [UNKNOWN] * len(got), np.zeros(len(got))
                rejected = np.ones(len(got), bool)
                if model is not None:
                    cosine = weigh(np.stack([c for c, _ in got]), model.idf) @ model.centroids.T
                    best = cosine.argmax(axis=1)
                    some = letters > 0
                    score = np.where(some, np.clip(cosine.max(axis=1), 0, 1), 0).astype(float)
                    lang = [model.langs[b] if s else UNKNOWN for b, s in zip(best, some)]
                    bits = np.array([int(n).bit_length() for n in letters])
                    rejected = ~some | (score < model.floor[bits])
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(n) for n in names], pa.array(lang, pa.string()), pa.array(score),
                     pa.array(rejected)], names=[*names, "lang_pred", "score", "rejected"])

    schema = (slim.select(*names).schema.add("lang_pred", "string").add("score", "double")
              .add("rejected", "boolean"))
    found = slim.mapInArrow(run, schema)
    return found.select(*[F.col(n).alias(c) for c, n in zip([id_col, *carry], names)],
                        "lang_pred", "score", "rejected")


def fold(id_col: str = "doc_id") -> Column:
    """CRC-32 of the id as text, modulo 4 (a null id is in no fold)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             carry: list[str] | None = None, **options) -> DataFrame:
    """``predict`` with a model of the labelled rows outside fold 2."""
    model = fit(docs.filter(fold(id_col) != 2), id_col=id_col, text_col=text_col, lang_col=lang_col, **options)
    return predict(docs, model, id_col, text_col, carry)
