"""Complement packing, source divergence, pair bitmaps, and language ID against brute force."""

import math
import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest

from arealens.llm import alignment, bestfit, divergence, langid, tokens
from pyspark.sql import functions as F


# ------------------------------------------------------------- tokens

def test_ids_and_token_bytes_are_those_of_the_libraries():
    from tokenizers import Tokenizer

    words = tokens.byte_vocabulary(tokens.default_vocabulary())
    library = Tokenizer.from_file(tokens.default_vocabulary())
    plain = Tokenizer.from_file(tokens.default_vocabulary())
    plain.encode_special_tokens = True
    slow = tokens.ByteVocabulary(tokens.default_vocabulary())
    slow.fast = slow.ranks = None
    for text in ("", "a b", "<|endoftext|> x <|endoftext|>", "é 漢字\n\n  z\t", "it's 12 ½", "\U0001F600 ", "a" * 500):
        want = library.encode(text, add_special_tokens=False).ids
        assert words.ids(text).tolist() == slow.ids(text).tolist() == want
        ids = words.ids(text, plain=True)
        assert ids.tolist() == slow.ids(text, plain=True).tolist() == plain.encode(text, add_special_tokens=False).ids
        for table in (words.token_bytes, slow.token_bytes):
            assert b"".join(table[i] for i in ids) == text.encode()
        pieces = tokens.piece_vocabulary(tokens.default_pieces())
        assert b"".join(pieces.token_bytes[i] for i in pieces.ids(text)) == (b" " + text.encode() if text else b"")
    assert words.token_bytes[:50256] == slow.token_bytes[:50256] and words.ids(None).size == 0


# ------------------------------------------------------------- complement packing

def _sequences(rows, window):
    own = defaultdict(list)
    for r in rows:
        own[r.sequence_id].append(r)
    for some in own.values():
        at = 0
        for r in sorted(some, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= window
    return own


def _check_pieces(rows, texts, window=1024):
    """``texts``: (id, text) of every row; pieces of repeated rows are repeated."""
    words = tokens.byte_vocabulary(tokens.default_vocabulary())
    want = Counter()
    for i, t in texts:
        ids = np.append(words.ids(t), np.array([2], "<u4")).astype("<u4")
        cuts = [0, *range(len(ids) % window or window, len(ids) + 1, window)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    own = _sequences(rows, window)
    sizes = [r.length for r in rows]
    assert math.ceil(sum(sizes) / window) <= len(own) <= brute.first_fit_decreasing(sizes, window)
    return len(own)


def test_documents_are_packed_into_few_sequences(spark, documents):
    data, df = documents
    rows = bestfit.pack_best_fit(df.repartition(3)).collect()
    _check_pieces(rows, data)


def test_complement_packing_edge_rows(spark, edges, nothing):
    rows = bestfit.pack_best_fit(edges).collect()
    _check_pieces(rows, [(r.doc_id, r.text) for r in edges.collect()])
    assert rows[0].asDict().keys() == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    assert bestfit.pack_best_fit(nothing).count() == 0
    ones = spark.createDataFrame([(i, "") for i in range(3000)], "doc_id int, text string")
    assert len(_sequences(bestfit.pack_best_fit(ones).collect(), 1024)) == 3  # 1024 separators each
    small = bestfit.pack_best_fit(ones.limit(1), window=1).collect()
    assert [(r.piece, r.start, r.length) for r in small] == [(0, 0, 1)]


def test_plans_use_every_piece_once_and_fill_gaps_exactly():
    rng = random.Random(2)
    for _ in range(60):
        window = rng.choice((16, 60, 128))
        whole = rng.randrange(1, 60)
        sizes = []
        for _ in range(whole):  # sequences cut into at most four parts, and some spare pieces
            cuts = sorted(rng.sample(range(1, window), rng.randrange(4)))
            sizes += [b - a for a, b in zip([0, *cuts], [*cuts, window])]
        spare = [rng.randrange(1, window + 1) for _ in range(rng.randrange(8))]
        counts = Counter(sizes + spare)
        patterns = bestfit.plan_patterns(dict(counts), window)
        used = Counter()
        for parts, times in patterns:
            assert times > 0 and sum(n * k for n, k in parts.items()) <= window
            for n, k in parts.items():
                used[n] += k * times
        assert used == counts
        bins = sum(times for _, times in patterns)
        assert math.ceil(sum(n * k for n, k in counts.items()) / window) <= bins
        assert bins <= brute.first_fit_decreasing(list(counts.elements()), window)
        placed = Counter()
        for s in bestfit.plan_segments(dict(counts), window):
            assert s.first == placed[s.length] and (s.last - s.first) % s.each == 0
            placed[s.length] = s.last
        assert placed == counts
    assert bestfit.plan_patterns({}, 8) == []
    # single, pair and triple complements
    free = np.zeros(11, np.int64)
    free[[2, 3, 5]] = 1
    pairs = bestfit.pair_sums(free)
    assert [bestfit.complement(g, 6, free, pairs) for g in (5, 8, 10, 9)] == [(5,), (5, 3), (5, 3, 2), None]


def test_a_hot_length_is_ranked_across_tasks(spark):
    same = spark.createDataFrame([(i, "one two three" if i % 3 else "a " * (i % 50)) for i in range(4000)],
                                 "doc_id long, text string").repartition(7)
    rows = bestfit.pack_best_fit(same, window=64).collect()
    assert len(rows) == 4000 and len({(r.sequence_id, r.offset) for r in rows}) == 4000
    _sequences(rows, 64)


# ------------------------------------------------------------- source divergence

@pytest.mark.parametrize("options", [{}, {"max_entries": 2000, "chunk": 50, "tile_size": 3}])
def test_divergences_against_brute_force(spark, documents, options):
    _, df = documents
    rows = [(r.lang, r.source, r.text) for r in df.collect()]
    got = divergence.source_divergence(df.repartition(3), **options)
    assert sorted(map(tuple, got.collect())) == brute.divergences(rows)


def test_divergence_edge_rows(spark, edges, nothing):
    assert divergence.source_divergence(nothing).count() == 0
    rows = [("en", "a", "x Y x z")] * 12 + [("en", "b", "x é É")] * 11 + [("en", None, None), ("en", "", "x"), ("en", "empty", "123 ...")]
    rows += [(None, "a", "few words"), (None, "b", "few words"), ("one", "only", "w w v")] + [("one", "only", "w")] * 10
    rows += [("en", "tie1", "x y"), ("en", "tie2", "x y"), ("en", "Ä", "😀 x".encode("utf-16", "surrogatepass").decode("utf-16"))]
    df = spark.createDataFrame([(*r, 1, "p", "v") for r in rows], "lang string, source string, text string, rank int, part string, value string")
    got = divergence.source_divergence(df)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute.divergences(rows)
    edge = [(r.lang, r.source, r.text) for r in edges.collect()]
    assert sorted(map(tuple, divergence.source_divergence(edges, least=1).collect())) == brute.divergences(edge, least=1)


def test_shares_are_exact_for_very_large_counts():
    counts = np.array([2, 10 ** 9, 8 * 10 ** 15, 3], np.int64)
    total = np.array([8 * 10 ** 15 + 11] * 4, np.int64)
    assert divergence.share(counts, total).tolist() == [1 + 10 ** 9 * int(c) // int(t) for c, t in zip(counts, total)]


def test_long_texts_are_folded_in_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "LONG", 50)
    text = ("alpha BETA é1x " * 40 + "w" * 200 + " end").encode()
    assert [t for part in divergence._terms(text) for t in part] == [
        t.encode() for t in brute.TERM.findall(text.decode().translate(brute.LOWER))]


# ------------------------------------------------------------- pair bitmaps

AWKWARD = [None, "", " ", "a▁b", "<|endoftext|> x <s> y </s> <unk>", "\x00z\n\n\n  x", "漢字\U0001F600" * 50, "a" * 3000, " lead",
           "x　y", "é", "the the the the", "<0x41> literal", "tail  ", "\r\n\t"]


@pytest.mark.parametrize("entries", [alignment.BLOCK_ENTRIES, 1500])
def test_links_against_brute_force(spark, documents, entries):
    data, _ = documents
    rows = [(i, t) for i, t in data[:120]] + [(10_000 + i, t) for i, t in enumerate(AWKWARD)] + [(10_011, "the the the the")]
    df = spark.createDataFrame([(*r, "b", 7) for r in rows], "doc_id long, text string, block string, pair int").repartition(3)
    got = alignment.align(df, block_entries=entries)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = [(i, *w) for (i, _), w in zip(rows, brute.alignments([t for _, t in rows]))]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_alignment_edge_rows(spark, edges, nothing):
    assert alignment.align(nothing).count() == 0
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    want = [(i, *w) for (i, _), w in zip(rows, brute.alignments([t for _, t in rows]))]
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, alignment.align(edges).collect()), key=order) == sorted(want, key=order)


def test_bitmaps_of_either_form_and_large_groups(monkeypatch):
    rng = np.random.default_rng(1)
    block = alignment._Block(5)
    want = defaultdict(dict)
    for d in range(300):
        pairs = np.unique(np.concatenate(([1, 2], rng.integers(3, 500, 20))))
        links = rng.integers(1, 40, len(pairs))
        block.add(pairs, links)
        for p, n in zip(pairs.tolist(), links.tolist()):
            want[p][d] = n
    got, forms = defaultdict(lambda: defaultdict(int)), set()
    for pair, plane, size, form, offsets, payload in block.postings():
        body = np.frombuffer(payload, np.uint8)
        docs = alignment._documents_of(form, size, offsets[:-1], offsets[1:], body)
        forms |= set(form.tolist())
        for p, d in zip(np.repeat(pair, size).tolist(), docs.tolist()):
            got[p][d] += 1 << max(plane - 1, 0)
    assert {p: dict(d) for p, d in got.items()} == want and forms == {alignment.NUMBERS, alignment.BITS}
    assert list(alignment._Block(1).postings()) == []
    a, b = rng.integers(0, 9, 60).astype("<u4"), rng.integers(0, 9, 50).astype("<u4")
    x, y = np.array([1, 40, 1, 18]), np.array([2, 30, 1, 17])
    count = Counter()
    for i in range(4):
        for u in a[x[:i].sum():x[:i + 1].sum()].tolist():
            for v in b[y[:i].sum():y[:i + 1].sum()].tolist():
                count[(u << alignment.SECOND_BITS) + v] += 1
    for size in (1 << 20, 100, 10, 1):
        monkeypatch.setattr(alignment, "SLICE", size)
        pairs, links = alignment.link_pairs(a, b, x, y)
        assert dict(zip(pairs.tolist(), links.tolist())) == count and np.all(np.diff(pairs) > 0)


# ------------------------------------------------------------- language ID

def test_languages_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame([(900_001, None), (900_002, ""), (900_003, "12 34"), (900_004, "日本語のテキスト"), (900_005, "x")],
                                "doc_id long, text string")
    docs = df.select("doc_id", "text", "lang").unionByName(odd, allowMissingColumns=True)
    model = langid.fit(docs.filter(langid.fold() != 2))
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    centroids, idf = model.centroids.astype(float), model.idf.astype(float)
    for r in docs.collect():
        grams, letters = brute.gram_counts(r.text)
        vector = {g: (1 + math.log(n)) * idf[g] for g, n in grams.items()}
        norm = math.sqrt(sum(v * v for v in vector.values()))
        found = got[r.doc_id]
        if not letters:
            assert (found.lang_pred, found.score, found.rejected) == ("und", 0.0, True)
            continue
        cosine = [sum(v * c[g] for g, v in vector.items()) / norm for c in centroids]
        best = max(cosine)
        assert abs(found.score - min(max(best, 0), 1)) < 1e-4
        assert found.lang_pred in {model.langs[i] for i, c in enumerate(cosine) if c > best - 1e-5}
        floor = model.floor[letters.bit_length()]
        assert found.rejected == (best < floor) or abs(best - floor) < 1e-4
    assert docs.count() == len(got)


def test_the_sample_of_many_languages_is_bounded(spark):
    rows = [(i, f"word{chr(97 + i % 26)} text {chr(97 + i % 7)}", f"l{i % 40}") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, sample_rows=80)
    assert len(set(model.langs)) == 40 and len(model.langs) <= 80
