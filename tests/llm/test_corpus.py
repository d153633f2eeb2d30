"""SimHash, packing, language ID, repeats, WARC, wrappers and neighbours against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import brute
import numpy as np
import pytest

from arealens.llm import graph, hilbert, langid, packing, repeats, simhash, warc, wrappers
from pyspark.sql import functions as F


# ------------------------------------------------------------- SimHash

def _groups(rows):
    return [(r.fingerprint, r.component_id) for r in rows]


@pytest.mark.parametrize("blocks", [5, 4, 3])
def test_near_duplicates_match_brute_force(spark, documents, blocks):
    data, df = documents
    got = {r.doc_id: r for r in simhash.near_duplicates(df, blocks=blocks).collect()}
    fps = [brute.fingerprint(t) for _, t in data]
    tops = brute.components([i for i, _ in data], fps)
    assert {i: (got[i].fingerprint, got[i].component_id) for i, _ in data} == {
        i: (f"{f:016x}", c) for (i, _), f, c in zip(data, fps, tops)}


@pytest.mark.parametrize("blocks", [5, 4, 2])
def test_links_of_crowded_fingerprints(spark, blocks):
    rng = np.random.default_rng(blocks)
    centres = rng.integers(0, 1 << 63, 6, dtype=np.int64)
    fps = {int(c) for c in centres}
    for c in centres:  # chains of near copies
        x = int(c)
        for _ in range(150):
            for b in rng.choice(63, rng.integers(1, 6), replace=False):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long").cache()
    links = simhash.hamming_links(df, 4, blocks, leaf_rows=16)
    assert all(bin(r.u ^ r.v).count("1") <= 4 for r in links.collect())
    member = {r.node: r.component for r in graph.components(links).collect()}
    want = brute.components(fps, fps)
    assert [member.get(f, f) for f in fps] == want


def test_large_shards_are_dealt_to_tiles(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 32)
    base = 0x0123456789ABCDEF
    fps = sorted({base ^ (1 << a) ^ (1 << b) for a in range(40, 62) for b in range(40, 62)})
    df = spark.createDataFrame([(f,) for f in fps], "fp long").cache()
    member = {r.node: r.component for r in graph.components(simhash.hamming_links(df, 4, 5)).collect()}
    assert set(member) == set(fps) and set(member.values()) == {min(fps)}


def test_components_of_a_long_chain(spark):
    order = list(range(300))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(149)]
                                  + [(order[i], order[i + 1]) for i in range(150, 299)], "u long, v long")
    got = {r.node: r.component for r in graph.components(edges).collect()}
    assert got == {x: min(part) for part in (order[:150], order[150:]) for x in part}
    assert graph.components(edges.limit(0)).count() == 0


def test_simhash_checkpoints_few_files_of_few_rows(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.choice((3, 12, 60))))) for i in range(300)]
    rows += [(1000 + i, "one text of very many copies") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    parts = []

    def counted(frame, cut=simhash.cut):
        done = cut(frame)
        parts.append(done.rdd.getNumPartitions())
        return done

    monkeypatch.setattr(simhash, "cut", counted)
    monkeypatch.setattr(graph, "cut", counted)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "41")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = simhash.near_duplicates(df)
        assert got.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
        found = {r.doc_id: r for r in got.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # the fingerprints keep the input's partitions, everything after them is sized by its rows
    assert parts[0] == 7 and max(parts[1:]) <= spark.sparkContext.defaultParallelism
    fps = {i: int(r.fingerprint, 16) for i, r in found.items()}
    for i, r in found.items():
        linked = [j for j in fps if (fps[i] ^ fps[j]).bit_count() <= 4]
        assert len(found) == 350 and r.component_id <= min(linked) and {found[j].component_id for j in linked} == {r.component_id}


def test_simhash_edge_rows(spark, edges, nothing):
    rows = simhash.near_duplicates(edges).collect()
    data = [(r.doc_id, r.text) for r in edges.collect()]
    fps = [brute.fingerprint(t) for _, t in data]
    want = sorted((str(i), f"{f:016x}", str(c)) for (i, _), f, c in zip(
        data, fps, brute.components([i for i, _ in data], fps)))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == want
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.keep_one(edges)
    assert kept.columns == edges.columns
    # one row of every group
    assert kept.count() == len({(w[2] if w[2] != "None" else w[1]) for w in want})
    assert simhash.keep_one(nothing).count() == 0


# ------------------------------------------------------------- packing

def _check_pieces(rows, texts, window=1024):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(packing.default_vocabulary()).encode
    parts, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        parts[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(parts) == set(texts)
    for i, t in texts.items():
        ids = np.array([*encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(parts[i], key=lambda r: r.start):
            own = ids[at:at + r.length]
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(own.tobytes()))
            assert np.array_equal(own, np.array(r.ids, np.int32).view("<u4"))
            at += r.length
        assert at == len(ids)
    padding = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


def test_pieces_put_together_are_the_documents(spark, documents):
    data, df = documents
    rows = packing.pack(df.repartition(2)).collect()
    padding = _check_pieces(rows, dict(data))
    assert padding < 0.01 * sum(r.length for r in rows)


def test_awkward_texts_are_encoded_as_the_library_does(spark, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK", 3000)
    texts = [None, "", " ", "  ", "\n", " a", "a ", "a  b", "a \n b", "\n a", "a\n\nb  \t c", "don't I'LL we've 'tis",
             "x y   z", "　日本語 テスト", "1 2  34५६ ½ Ⅷ", "<|endoftext|> a <|endoftext|>", "\U0001F600 \U0001F600",
             "a\x1cb \x1c c", "é é", "\r\n x\r\n", "word. " * 9000, "nosentenceend " * 5000, "ab" * 4000,
             "end.  Next!  What?  "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _check_pieces(packing.pack(df).collect(), dict(enumerate(texts)))


def test_cuts_are_optimal():
    rng = random.Random(5)
    for _ in range(60):
        window = rng.choice((8, 13, 16))
        at = [0]
        while len(at) < 40:
            at.append(at[-1] + rng.randint(1, window))
        price = [0] + [rng.choice((0, 0, 1.5, 6)) for _ in at[1:]]
        cuts = packing.plan_cuts(np.array(at), np.array(price, float), window)
        assert cuts[0] == 0 and cuts[-1] == len(at) - 1
        cost = sum((0 if (n := at[j] - at[i]) & (n - 1) == 0 else window - n) + price[j] for i, j in zip(cuts, cuts[1:]))
        assert all(at[j] - at[i] <= window for i, j in zip(cuts, cuts[1:]))
        assert cost == brute.best_cuts(at, price, window)


def test_cuts_are_optimal_with_every_power_of_two():
    rng = random.Random(1)
    window = 1024
    for _ in range(40):
        ends = sorted({0, *[rng.randrange(1, 6000) for _ in range(rng.randrange(20, 120))]})
        more = {a + window for a in ends} | {a + p for a in ends for p in (1, 2, 8, 16) if rng.random() < 0.1}
        at = [0]
        for x in sorted(set(ends[1:]) | {m for m in more if m < ends[-1]}):
            while x - at[-1] > window:
                at.append(at[-1] + window)
            at.append(x)
        price = [rng.choice((0, 2, 12)) for _ in at]
        cuts = packing.plan_cuts(np.array(at), np.array(price, float), window)
        cost = sum((0 if (n := at[j] - at[i]) & (n - 1) == 0 else window - n) + price[j] for i, j in zip(cuts, cuts[1:]))
        assert cost == brute.best_cuts(at, price, window)


def test_packing_edge_rows(spark, edges, nothing):
    rows = packing.pack(edges).collect()
    count = defaultdict(int)
    for r in rows:
        count[r.doc_id] += r.length
    want = defaultdict(int)
    for r in edges.collect():
        want[r.doc_id] += next(p.doc_tokens for p in rows if p.doc_id == r.doc_id) if r.doc_id is not None else 0
    assert {k: v for k, v in count.items() if k is not None} == {k: v for k, v in want.items() if k is not None}
    assert count[None] > 1
    assert packing.pack(nothing).count() == 0


# ------------------------------------------------------------- language ID

def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(df, carry=["lang"]).filter(langid.fold() == 2).collect()
    assert len(rows) > 150 and sum(r.lang == r.lang_pred for r in rows) > 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows) and sum(r.rejected for r in rows) <= 0.01 * len(rows)


def test_counts_do_not_depend_on_pieces(monkeypatch):
    text = "Ça va bien, merci! Größe 12 straße " * 30
    whole, letters = langid.counts(text)
    assert letters == sum(c.isalpha() for c in text.lower()) and whole.sum() > letters
    assert langid.counts(None)[1] == langid.counts("12 .. 一"[:5])[1] == 0


def test_language_edge_rows(spark, edges, nothing):
    rows = langid.identify(edges).collect()
    assert len(rows) == edges.count()
    for r in rows:
        if r.doc_id in (1, 2, 3, 4):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        elif r.doc_id is not None:
            assert r.lang_pred == "en"
    assert langid.identify(nothing).count() == 0
    unlabelled = langid.identify(edges.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}


# ------------------------------------------------------------- repeats

def _check_repeats(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in
           repeats.remove_repeats(df, **options).collect()}
    assert got == dict(enumerate(brute.repeats(texts, options.get("width", 200))))
    return sum(g[1] for g in got.values())


def test_repeats_match_brute_force(spark, documents):
    assert _check_repeats(spark, [t for _, t in documents[0]]) > 0


@pytest.mark.parametrize("shard", [1 << 15, 2])
def test_repeats_at_every_edge(spark, shard):
    rng = random.Random(shard)

    def noise(n):
        return "".join(rng.choice("abcdefgh é") for _ in range(n))

    shared = noise(260)
    texts = [noise(rng.randint(0, 300)) + shared[rng.randint(0, 60):260 - rng.randint(0, 60)] + noise(rng.randint(0, 300))
             for _ in range(30)]
    texts += [shared[:199], shared[:200], shared[1:201], None, "", "a" * 450, "ab" * 300, texts[0], noise(400) * 2,
              texts[1][:-1] + "x"]
    assert _check_repeats(spark, texts, shard=shard) > 0


def test_texts_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 1 << 12)
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefgh ") for _ in range(15000))
    texts = [long, "x" + long[3000:9000], long[:5000] + "y", "z" * 30]
    got = repeats.all_reads([t.encode() for t in texts], 200, 56)
    windows = sum(int((last - first + 1).sum()) for _, _, _, _, _, _, first, last in got)
    assert windows == sum(max(0, len(t) - 199) for t in texts)


def test_column_order_finds_equal_windows():
    rng = random.Random(3)
    parts = ["".join(rng.choice("ab") for _ in range(rng.randint(5, 9))).encode() for _ in range(200)]
    first = np.array([rng.randint(0, 9 - len(p)) for p in parts])
    flags = repeats.repeated_starts(parts, first, 5, 9)
    seen = defaultdict(int)
    for p, f in zip(parts, first):
        for i in range(len(p) - 4):
            seen[f + i, p[i:i + 5]] += 1
    for i, (p, f) in enumerate(zip(parts, first)):
        for x in range(5):
            inside = f <= x <= f + len(p) - 5
            assert flags[i, x] == (inside and seen[x, p[x - f:x - f + 5]] > 1)


def test_repeats_edge_rows(spark, edges, nothing):
    rows = repeats.remove_repeats(edges).collect()
    want = brute.repeats([r.text for r in edges.collect()])
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == sorted(
        (a, b, c, hashlib.sha256(k).hexdigest()) for a, b, c, k in want)
    assert repeats.remove_repeats(nothing).count() == 0


# ------------------------------------------------------------- WARC

def test_archives_come_back(spark, scratch):
    big = "payload é " * 40000
    pages = [(1, "http://a/\r\nx", big), (2, None, big), (3, "http://b/", None), (4, "http://b/", ""),
             (5, "http://c/", "x" * 999), (6, "http://c/", "x" * 999), (7, "http://d/é", "y" * 1000), (8, "u", "y" * 1000),
             (9, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 300), (10, "u", big), (10, "u", big), (None, "u", "only null " * 200),
             (None, "u", "y" * 1000)]
    df = spark.createDataFrame([(*p, 1, "x") for p in pages],
                               "page_id long, url string, html string, id long, digest string")
    manifest, folder = warc.archive(df, scratch + "/warc")
    assert folder == scratch + "/warc"
    rows = warc.read_records(manifest, folder).collect()
    best = defaultdict(list)
    for i, _, t in pages:
        if i is not None:
            best[t].append(i)
    want = []
    for i, _, t in pages:
        raw = (t or "").encode()
        refers = max(best[t], default=None) if len(raw) >= 1000 else None
        revisit = refers is not None and refers != i
        want.append((str(i), len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response",
                     str(refers) if revisit else "None"))
    assert sorted((str(r.id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in rows) == sorted(want)
    chunks = warc.read_chunks(manifest, folder).filter("id = '10'").orderBy("place", "chunk_no").collect()
    one = [c for c in chunks if c.place == chunks[0].place and c.file == chunks[0].file]
    assert len(one) > 3 and max(len(c.data) for c in one) <= warc.CHUNK and [c.last for c in one].count(True) == 1
    assert b"".join(bytes(c.data) for c in one) == big.encode()
    sha = hashlib.sha1()
    for c in one:
        sha.update(bytes(c.data))
        assert c.digest_so_far == sha.hexdigest()


def test_archives_of_the_test_pages(spark, scratch):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    manifest, folder = warc.archive(df, scratch + "/warc")
    got = {r.id: (r.payload_bytes, r.payload_digest) for r in warc.read_records(manifest, folder).collect()}
    assert got == {str(r.page_id): (len(r.html.encode()), hashlib.sha1(r.html.encode()).hexdigest()) for r in df.collect()}
    empty, folder = warc.archive(df.limit(0), scratch + "/none")
    assert empty.count() == 0 and warc.read_records(empty, folder).count() == 0


def test_a_damaged_archive_fails(spark, scratch):
    import glob

    df = spark.createDataFrame([(1, "u", "z" * 5000)], "page_id long, url string, html string")
    manifest, folder = warc.archive(df, scratch + "/warc")
    path = glob.glob(folder + "/*.warc")[0]
    data = open(path, "rb").read().replace(b"zzz", b"zaz", 1)
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="digest"):
        warc.read_records(manifest, folder).collect()


# ------------------------------------------------------------- wrappers

def _page(i, body, side="menu"):
    return (f"<html><head><title>t{i}</title><script>var a='<p>no</p>'</script></head><body><header><h1>Site</h1></header>"
            f"<div class='{side}'><a href='/{i}'>link {i}</a></div>{body}<div id=cookie-notice>We use cookies</div>"
            f"<form><input name=q>Search</form><footer>&copy; {i}</footer></body></html>")


def test_wrapper_generalises_to_optional_and_repeated_groups():
    pages = ["<div><h1>A</h1><p>one</p><hr><b>x</b></div>", "<div><h1>B</h1><p>two</p><p>three</p><b>x</b></div>"]
    assert wrappers.infer(pages).pattern() == "<><div><h1>(.*)</>(?:<p>(.*)</>)+(?:<hr></>)?<b>x</></></>"


def test_main_text_of_marked_and_unmarked_articles(spark):
    article = "<article><h1>T &amp; {0}</h1><p>first  {0}\n line<br>more<p><b>second</b> {0}<ul><li>a{0}<li>b</ul>" \
              "<section class='comments'><article class=comment><p>great</p></article></section></article>"
    plain = "<div class=wrap><div class=story><h2>T{0}</h2><p>words of text {0} and more of them</p><p>again {0}</p>" \
            "<h5>Read our rules</h5></div><div class=sidebar><p>side {0}</p></div></div>"
    rows = [(i, f"http://a.example/{i}", _page(i, article.format(i))) for i in range(6)]
    rows += [(10 + i, f"https://b.example/{i}?q", _page(i, plain.format(i))) for i in range(6)]
    rows += [(20, None, _page(1, plain.format(7))), (21, "odd", ""), (22, "http://a.example/n", None),
             (23, "http://a.example/z", _page(3, plain.format(8)))]
    df = spark.createDataFrame([(*r, "c", "r") for r in rows], "page_id long, url string, html string, host string, rules string")
    got = {r.page_id: r for r in wrappers.extract_pages(df).collect()}
    assert len(got) == len(rows)
    for i in range(6):
        assert got[i].text == f"T & {i}\n\nfirst {i} line more\n\nsecond {i}\n\na{i}\n\nb"
        # a text that all of a host's pages share is no part of an unmarked article
        assert got[10 + i].text == f"T{i}\n\nwords of text {i} and more of them\n\nagain {i}"
    assert got[20].text.startswith("T7\n\nwords") and got[23].text.startswith("T8\n\nwords")
    assert got[21].text == got[22].text == "" and got[22].n_chars == 0
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert wrappers.extract_pages(df.limit(0)).count() == 0


def test_constant_texts_are_counted_over_all_pages(spark):
    story = "<div class=story><h2>T{0}</h2><p>words of text {0} and more of them</p>{1}<p>again {0}</p>" \
            "<h5>Read <b>our</b> rules</h5></div>"
    ends = "<h3>Conclusion</h3><table><tr><td>all in all</td></tr></table>"  # of every second page
    rows = [(i, f"http://many.example/{i}", _page(i, story.format(i, ends if i % 2 else ""))) for i in range(30)]
    rows += [(100 + i, "http://few.example/", _page(i, story.format(i, ends))) for i in range(3)]
    rows += [(200 + i, "http://one.example/", _page(1, "<h1>Head</h1><p>only paragraph</p>")) for i in range(8)]
    rows += [(300 + i, "http://same.example/", _page(i, "<div class=story><p>one text</p></div>")) for i in range(8)]
    rows[7] = (7, rows[7][1], rows[7][2].replace("<p>again", "<ul><li>seen once</ul><p>again"))
    df = spark.createDataFrame(rows, "page_id int, url string, html string")
    got = {r.page_id: r.text.split("\n\n") for r in wrappers.extract_pages(df).collect()}
    for j in range(30):
        assert got[j] == [f"T{j}", f"words of text {j} and more of them", *(["Conclusion", "all in all"] if j % 2 else []),
                          *(["seen once"] if j == 7 else []), f"again {j}"]
    for j in range(3):  # too few pages to tell
        assert got[100 + j][-4:] == ["Conclusion", "all in all", f"again {j}", "Read our rules"]
    assert all(got[200 + j][-2:] == ["Head", "only paragraph"] and got[300 + j] == ["one text"] for j in range(8))


def test_copies_of_a_sampled_page_are_one_before_the_ranking(spark):
    rows = [(f"http://a.example/{i}", _page(i % 6, f"<article><p>{i % 6}</p></article>") if i % 3 else
             _page(0, "<article><p>0</p></article>")) for i in range(300)]
    df = spark.createDataFrame(rows, "url string, html string")
    seen = []
    whole = wrappers.cut
    try:
        wrappers.cut = lambda frame: seen.append(frame) or whole(frame)
        got = wrappers.host_wrappers(df).collect()
    finally:
        wrappers.cut = whole
    assert len(got) == 1 and len(seen) == 1
    assert "html" not in seen[0].columns and seen[0].count() == len({tuple(r) for r in seen[0].collect()}) == 4


def test_wrappers_come_from_every_page_not_from_a_few(spark, monkeypatch):
    # the four pages that a sample would take have another layout than all the others
    box = "<div class=box><div class=inner><p>" + "same words everywhere " * 30 + "</p></div></div>"
    wall = "<html><body><div class=wall><h2>Wall {0}</h2><p>log in at once, visitor {0}</p></div></body></html>"
    story = "<html><body>" + box + "<div class=story><h2>T{0}</h2><p>words {0} of this page alone</p></div></body></html>"
    pages = spark.createDataFrame([(i, f.format(i), f is wall) for f in (wall, story) for i in range(300)],
                                  "i long, html string, wall boolean").selectExpr("*", "xxhash64(html) h").collect()
    walls = sorted((p for p in pages if p.wall), key=lambda p: p.h)[:wrappers.SAMPLE_PAGES]
    stories = [p for p in pages if not p.wall and p.h > walls[-1].h][:40]
    assert len(stories) == 40
    # one story has another box: it is nearly always the same
    rows = [(p.i + 1000 * p.wall, "http://s.example/", p.html) for p in walls + stories]
    rows[-1] = (*rows[-1][:2], rows[-1][2].replace("same words everywhere", "almost the same"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {p.i: f"T{p.i}\n\nwords {p.i} of this page alone" for p in stories}
    want |= {1000 + p.i: f"Wall {p.i}\n\nlog in at once, visitor {p.i}" for p in walls}
    assert {r.page_id: r.text for r in wrappers.extract_pages(df).collect()} == want
    whole = wrappers.host_wrappers(df, None).collect()
    assert len(whole) == 1 and wrappers.host_wrappers(df.limit(0), None).count() == 0
    # copies, order and partitions change nothing; nor does the text with many buckets on several levels
    copies = df.unionByName(df).unionByName(df.limit(9)).orderBy("html").repartition(5)
    assert wrappers.host_wrappers(copies, None).collect() == whole
    monkeypatch.setattr(wrappers, "BUCKET_PAGES", 3)
    monkeypatch.setattr(wrappers, "FAN", 2)
    levels = wrappers.host_wrappers(copies, None).collect()
    assert levels == wrappers.host_wrappers(df, None).collect() and len(levels) == 1
    assert {r.page_id: r.text for r in wrappers.extract_pages(df).collect()} == want
    import re

    assert all(re.fullmatch(levels[0].pattern, _stream(r[2]), re.S) for r in rows)


def test_wrappers_of_wrappers_cover_their_pages():
    import re

    rng = random.Random(12)
    for _ in range(200):
        pages = ["".join(f"<{t}>{rng.choice(('x', 'y', ''))}</{t}>" for t in rng.choices(("p", "b", "ul", "i"), k=rng.randrange(1, 7)))
                 for _ in range(rng.randrange(1, 9))]
        halves = [wrappers.infer(part).dump() for part in (pages[::2], pages[1::2]) if part]
        assert all(wrappers.load(h).dump() == h and wrappers.load(h).pattern() for h in halves)
        whole = wrappers.infer(halves, wrappers.load)
        assert whole.seen == len(pages) and all(re.fullmatch(whole.pattern(), _stream(p), re.S) for p in pages)


def test_main_text_of_the_test_pages(spark):
    import html
    import re

    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r, page in zip(wrappers.extract_pages(df).orderBy("page_id").collect(), df.orderBy("page_id").collect()):
        inner = re.search(r"<article>(.*)</article>", page.html, re.S)[1].replace("<br>", " ")
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip()
                  for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(b for b in blocks if b)


def _stream(page):
    """The page's tokens as the text that a wrapper's expression is matched against."""
    out = []
    for node, before in wrappers.tree(page, grouped=False).walk():
        out.append((node.text if before else "") if node.sig == "#" else f"<{node.sig}>" if before else "</>")
    return "".join(out)


def test_a_wrapper_covers_every_page_it_was_inferred_from():
    import re

    rng = random.Random(11)

    def part(depth):
        kids = "".join(part(depth + 1) if depth < 3 and rng.random() < 0.6 else rng.choice(("x", "y", "long text", ""))
                       for _ in range(rng.randrange(4)))
        tag = rng.choice(("div", "p", "ul", "b", "section", "div class='a.b'", "li"))
        return f"<{tag}>{kids}</{tag.split()[0]}>"

    for _ in range(300):
        pages = ["".join(part(0) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(1, 4))]
        pattern = wrappers.infer(pages).pattern()
        for page in pages:
            assert re.fullmatch(pattern, _stream(page), re.S), (pattern, page)


def test_aligned_signatures_are_a_longest_common_subsequence():
    rng = random.Random(3)

    def longest(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]

    for _ in range(300):
        a, b = [[rng.choice("abcd") for _ in range(rng.randrange(9))] for _ in range(2)]
        pairs = wrappers._common(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and len(pairs) == longest(a, b)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
    many = ["a", "b"] * 20_000
    pairs = wrappers._common(many, ["b", *many])
    assert len(pairs) >= 39_999


def test_article_parts_and_odd_classes_are_kept(spark):
    one = ("<main><article class='teaser'><p>teaser text {0}</p></article><article class='full'><h1>Title {0}</h1>"
           "<section class='social-history'><p>history {0}</p></section><div class='search-methods'>methods {0}</div>"
           "<p>sum <math><mi>x</mi><mo>=</mo><mn>{0}</mn></math></p><div class='ad-slot'>buy</div>"
           "<section id='comments-section'>nice</section><div class='social-share'>share</div></article></main>")
    rows = [(i, f"http://h.example/{i}", _page(i, one.format(i))) for i in range(4)]
    rows += [(7, "http://k.example/7", "<body class='sidebar-right'><main class='has-comments social'><p>body text</p></main></body>")]
    rows.append((9, "http://h.example/9", _page(9, "<div><article class='new'><p>another layout</p></article></div>")))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrappers.extract_pages(df).collect()}
    for i in range(4):
        assert got[i] == f"teaser text {i}\n\nTitle {i}\n\nhistory {i}\n\nmethods {i}\n\nsum x={i}"
    assert got[9] == "another layout" and got[7] == "body text"


def test_the_wrapper_finds_unmarked_articles_where_the_page_alone_does_not(spark):
    # the box has more text than the story, but the same on every page: only aligned pages tell
    page = "<div class=box><div class=inner><p>" + "same words everywhere " * 30 + "</p></div></div>" \
           "<div class=story><h2>T{0}</h2><p>words {0} of this page alone</p></div>"
    rows = [(i, f"http://u.example/{i}", f"<html><body>{page.format(i)}</body></html>") for i in range(6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrappers.extract_pages(df).collect()}
    assert got == {i: f"T{i}\n\nwords {i} of this page alone" for i in range(6)}
    assert wrappers.main_text(rows[0][2], None).startswith("same words")


def test_deep_and_unclosed_markup_is_read_in_linear_time(spark):
    import time

    pages = ["<b>" * 100_000 + "x", "<div>" * 3_000 + "deep" + "</div>" * 3_000, '<a "' * 100_000, "<p a='" * 50_000,
             "<article>" + "<b>" * 50_000 + "<p>" * 50_000 + "tail", "<ul>" + "<b>" * 20_000 + "<li>x" * 20_000,
             "</i>" * 100_000 + "<article>y</article>", "<!--" * 50_000, "<table>" + "<tr><td>c" * 20_000,
             "<article>" + "<b>u</b><i>v</i>" * 20_000 + "</article>", "<div>" * 2_000 + "<p>q" + "</div>" * 1_000 + "<p>r"]
    start = time.time()
    for page in pages:
        assert isinstance(wrappers.main_text(page, None), str)
    wrapper = wrappers.infer(pages)  # as if one host had them all
    assert wrapper.pattern() and wrappers.describe(wrapper)["marked"] == "article"
    rows = [(i, "http://deep.example/", p) for i, p in enumerate([*pages, "<article><p>plain</p></article>"])]
    got = {r.page_id: r.text for r in wrappers.extract_pages(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[len(pages)] == "plain" and got[6] == "y" and got[1] == "deep" and got[0] == "x" and got[4] == "tail"
    assert time.time() - start < 120


def test_broken_markup_does_not_fail():
    for page in ("<", "<p", "<p><p><", "</p></div>", "<a href='x", "<!-- open", "<script>x", "<li>" * 2000, "&#xZ; &bogus; &amp",
                 "<div " + "a='b' " * 3000 + ">x</div>", "<article>" * 300 + "deep"):
        assert isinstance(wrappers.main_text(page, None), str)


# ------------------------------------------------------------- neighbours

def test_hilbert_keys_visit_neighbouring_cells():
    side = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    order = side[np.argsort(hilbert.hilbert_keys(side, 3))]
    assert len(set(hilbert.hilbert_keys(side, 3).tolist())) == 512
    assert (np.abs(np.diff(order.astype(int), axis=0)).sum(axis=1) == 1).all()


def test_recall_and_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = df.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    found = defaultdict(list)
    for r in hilbert.nearest(df).collect():
        found[r.query_id].append(r)
    assert set(found) == {int(i) for i in ids if i % 20 == 0}
    hits = 0
    for q, got in found.items():
        score = x @ x[list(ids).index(q)]
        best = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:20]
        got = sorted(got, key=lambda r: r.rank)
        assert [r.rank for r in got] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in got] == sorted((-r.score, r.vec_id) for r in got)
        assert np.allclose([r.score for r in got], [score[list(ids).index(r.vec_id)] for r in got], rtol=0, atol=1e-12)
        hits += len({r.vec_id for r in got} & {int(ids[i]) for i in best})
    assert hits >= 0.9 * 20 * len(found)


@pytest.mark.parametrize("n", [1, 2, 5, 10, 15, 20, 22, 40])
def test_small_tables_are_searched_whole(spark, n):
    x = np.random.default_rng(n).normal(size=(n, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = defaultdict(list)
    for r in hilbert.nearest(df).collect():
        found[r.query_id].append((r.rank, r.vec_id))
    for q in range(0, n, 20):
        best = [int(i) for i in np.lexsort((np.arange(n), -(x @ x[q]))) if i != q][:20]
        assert len(found[q]) == min(20, n - 1)
        if n <= 22:  # every candidate is owed
            assert [i for _, i in sorted(found[q])] == best


def _recall(spark, x, **options):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>").repartition(4)
    found = defaultdict(set)
    for r in hilbert.nearest(df, **options).collect():
        found[r.query_id].add(r.vec_id)
    hits = []
    for q in range(0, len(x), 20):
        score = x @ x[q]
        score[q] = -np.inf
        hits.append(len(found[q] & set(np.argsort(-score)[:20].tolist())) / 20)
    return float(np.mean(hits))


def test_recall_with_uneven_norms_and_clusters(spark):
    rng = np.random.default_rng(2)
    even = rng.normal(size=(3000, 64))
    even /= np.linalg.norm(even, axis=1, keepdims=True)
    assert _recall(spark, even) >= 0.9
    for spread in (0.5, 1.0):
        assert _recall(spark, even * rng.lognormal(0, spread, (3000, 1))) >= 0.9
    centres = rng.normal(size=(60, 64))
    clustered = centres[rng.integers(0, 60, 3000)] + 0.15 * rng.normal(size=(3000, 64))
    assert _recall(spark, clustered / np.linalg.norm(clustered, axis=1, keepdims=True)) >= 0.9
    outlier = even.copy()
    outlier[7] *= 1e4
    assert _recall(spark, outlier) >= 0.9
    assert _recall(spark, even, curves=1, segments=1) == 1.0


def test_copies_ties_and_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(200)] + [(200 + i, [0.5, 0.1 * i, 1.0]) for i in range(10)]
    rows += [(220, None), (240, [0.0, 0.0, 0.0]), (260, [inf, 1.0, 0.0]), (280, [nan, 1.0, 0.0]), (300, [1.0, None, 0.0]),
             (320, []), (340, [1.0]), (None, [9.0, 9.0, 9.0]), (0, [1.0, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, id long, vec string")
    found = defaultdict(list)
    for r in hilbert.nearest(df, curves=2, segments=2).collect():
        found[r.query_id].append(r)
    assert sorted(found) == list(range(0, 201, 20))
    for q in range(0, 200, 20):
        got = sorted(found[q], key=lambda r: r.rank)
        assert [r.vec_id for r in got] == [i for i in range(22) if i != q][:20] and {r.score for r in got} == {1.0}
    few = hilbert.nearest(df.filter("vec_id >= 199 and vec_id < 205"), curves=2, segments=2).collect()
    assert {r.query_id for r in few} == {200} and len(few) == 5
    assert hilbert.nearest(df.limit(0)).count() == 0
    assert hilbert.nearest(df.filter("vec_id % 20 = 1")).count() == 0
