"""The pipeline's stages on their own inputs, and the registered corpus queries."""

import random
import string

import brute
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from arealens.llm import packing
from arealens.llm.queries import LLM_QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """[(name, input rows, output rows, columns)] of all stages, each written and read again."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "out")
        stage(spark, docs, DATA).write.parquet(path)
        got = spark.read.parquet(path)
        out.append((name, docs.collect(), got.collect(), got.columns))
        docs = got
    return out


def test_stages_keep_the_documents_columns(stages):
    for name, before, after, columns in stages[:-1]:
        assert columns == ["doc_id", "text", "lang", "source", "n_chars"], name


def test_language_stage_keeps_clean_documents(stages):
    _, before, after, _ = stages[0]
    kept = {r.doc_id for r in after}
    assert all(any(c.isalpha() for c in r.text) for r in after)
    assert len(kept) >= len(before) - 2 - sum(not any(c.isalpha() for c in r.text) for r in before)


def test_language_stage_drops_what_is_no_language(spark):
    draw = random.Random(3)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    clean = [r.text for r in docs.orderBy("doc_id").limit(400).collect()]
    kinds = {"latin": string.ascii_lowercase, "base64": string.ascii_letters + string.digits + "+/",
             "cyrillic": "".join(map(chr, range(0x430, 0x450))), "greek": "".join(map(chr, range(0x3b1, 0x3ca))),
             "hebrew": "".join(map(chr, range(0x5d0, 0x5eb))), "han": "".join(map(chr, range(0x4e00, 0x6e00)))}
    planted = {}
    for kind, letters in kinds.items():
        for n in (120, 400, 1500, 5000, 20000, 70000, 300000):
            words, left = [], n
            while left > 0:
                words.append("".join(draw.choices(letters, k=76 if kind == "base64" else draw.randint(2, 9))))
                left -= len(words[-1])
            planted[f"{kind}-{n}"] = " ".join(words)
    for n in (3, 30, 150, 400):  # long texts of a language stay
        planted[f"clean-{n}"] = "\n".join(t for t in clean[:n] if t)
    rows = [(-i, text, None, kind, len(text)) for i, (kind, text) in enumerate(planted.items(), 1)]
    both = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    left = {r.doc_id: r.source for r in corpus_pipeline.language_id(spark, both, DATA).select("doc_id", "source").collect()}
    assert sorted(s for i, s in left.items() if i < 0) == sorted(k for k in planted if k.startswith("clean"))
    lost = docs.filter(~F.col("doc_id").isin([i for i in left if i > 0])).collect()
    assert sum(any(c.isalpha() for c in r.text or "") for r in lost) <= 0.002 * docs.count()


def test_near_dedup_stage_keeps_one_of_each_group(stages):
    _, before, after, _ = stages[1]
    before = sorted(before, key=lambda r: r.doc_id)
    tops = brute.components([r.doc_id for r in before], [brute.fingerprint(r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted(set(tops))


def test_decontamination_stage_drops_exactly_the_hit_documents(spark, stages):
    _, before, after, _ = stages[2]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    hits = brute.contamination([r.text for r in before], items)
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for i, r in enumerate(before) if not hits[i][1])


def test_secret_stage_redacts_and_keeps_every_document(stages):
    _, before, after, _ = stages[3]
    texts = {r.doc_id: r.text for r in before}
    assert sorted(texts) == sorted(r.doc_id for r in after)
    for r in after:
        assert not brute.base_secrets(r.text) and r.n_chars == len(r.text)
        if not brute.base_secrets(texts[r.doc_id]) and "[secret]" not in r.text:
            assert r.text == texts[r.doc_id]


def test_packing_stage_holds_every_id(stages):
    _, before, after, _ = stages[4]
    encode = Tokenizer.from_file(packing.default_vocabulary()).encode
    for r in before:
        own = sorted((p for p in after if p.doc_id == r.doc_id), key=lambda p: p.start)
        assert [i for p in own for i in p.ids] == [*encode(r.text, add_special_tokens=False).ids, 0]


def test_run_equals_the_stages(spark, stages):
    pieces = entry.queries()["pipeline"](spark, DATA)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in stages[4][1]}


def test_stages_take_edge_rows(spark, edges, nothing):
    docs, none = edges, nothing
    for _, stage in corpus_pipeline.STAGES:
        docs, none = stage(spark, docs, DATA), stage(spark, none, DATA)
        assert none.count() == 0 and docs.columns == none.columns
    assert docs.count() > 0


@pytest.mark.parametrize("name", sorted(LLM_QUERIES))
def test_queries_return_their_contract(spark, name):
    columns = {
        "op1": "doc_id start length ids_crc32 doc_tokens sequence_id offset", "op2": "doc_id fingerprint component_id",
        "op3": "doc_id n_assign n_access n_hex base_sha256 spans", "op4": "page_id url text n_chars",
        "op5": "page_id payload_bytes payload_digest record_type refers_to", "op6": "query_id rank vec_id score",
        "op7": "doc_id size text_crc32 law shard slot grown_shard",
        "op8": "doc_id n_words n_hit n_items items_sha256 contaminated", "op9": "doc_id held_out lang_pred score",
        "op10": "doc_id n_bytes n_removed n_spans kept_sha256",
        "op11": "doc_id piece start length ids_crc32 sequence_id offset", "op12": "lang source part item value rank",
        "op13": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256"}[name.split("_")[0]].split()
    df = LLM_QUERIES[name](spark, DATA)
    assert set(columns) <= set(df.columns)
    rows = spark.read.parquet(f"{DATA}/{'pages' if name[:4] in ('op4_', 'op5_') else 'documents'}.parquet").count()
    if name.split("_")[0] not in ("op1", "op6", "op11", "op12"):
        assert df.count() == rows
    kinds = dict(df.dtypes)
    for c, kind in (("start", "bigint"), ("rank", "int"), ("shard", "int"), ("slot", "bigint"), ("n_hit", "bigint"),
                    ("refers_to", "bigint"), ("score", "double"), ("ids_crc32", "bigint"), ("grown_shard", "int"),
                    ("piece", "int"), ("value", "bigint"), ("n_best", "bigint"), ("count_sum", "bigint")):
        assert kinds.get(c, kind) == kind


def test_oracles_agree(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    sql = entry.oracle_sql()
    for name in LLM_QUERIES:
        if name in sql:
            want = con.sql(sql[name]).df()
            got = LLM_QUERIES[name](spark, DATA).toPandas()[list(want.columns)]
            assert _values(got) == _values(want), name


def _values(df):
    import pandas as pd

    def plain(v):
        return "" if pd.isna(v) else str(int(v) if isinstance(v, float) and v.is_integer() else v)

    return sorted(tuple(map(plain, row)) for row in df.itertuples(index=False))
