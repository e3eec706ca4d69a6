"""Registered training-data queries and the pipeline on the smallest tables."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from shardwise.llm import credentials, decontaminate, packing, queries, textvec, toxicity
from tests.conftest import SF001, SF01
from tests.llm.test_text_operators import brute_links

COLUMNS = {
    "op1_nearest": ["query_id", "rank", "vec_id", "score"],
    "op2_ngram_join": ["doc_id", "class_id", "copies", "n_links"],
    "op3_url_filter": ["page_id", "host", "path", "rule", "verdict", "lm_score"],
    "op4_licenses": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op5_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op6_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op7_decontamination": ["doc_id", "item_id", "score", "first_word", "end_word", "seeds"],
    "op8_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op9_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op10_html_text": ["page_id", "url", "text", "n_chars"],
    "op11_chosen_path": ["doc_id", "n_shingles", "component_id", "kept"],
    "op12_signature_search": ["item_id", "rank", "doc_id", "score"],
    "op13_periodic_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
}
PER_ROW = {"op2_ngram_join": "documents", "op3_url_filter": "pages", "op4_licenses": "documents", "op5_sharding": "documents", "op8_toxicity": "documents", "op9_secrets": "documents", "op10_html_text": "pages", "op11_chosen_path": "documents", "op13_periodic_runs": "documents"}


def test_all_are_registered():
    assert set(COLUMNS) == set(queries.QUERIES) and set(COLUMNS) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    df = queries.QUERIES[name](spark, SF001)
    assert df.columns == COLUMNS[name]
    n = df.count()
    assert n > 0
    if name in PER_ROW:
        assert n == spark.read.parquet(f"{SF001}/{PER_ROW[name]}.parquet").count()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql_oracles(spark, name):
    from tests.duck import connect
    from tests.oracle_check import digest

    df = queries.QUERIES[name](spark, SF01)
    cur = connect(SF01).execute(queries.ORACLE[name])
    columns, rows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(columns) == sorted(df.columns)
    assert digest(columns, rows)[0] == digest(df.columns, [tuple(r) for r in df.collect()])[0]


def test_held_out_ids(spark):
    ids = spark.range(200).select("id", queries.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in ids)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF001).cache()
        assert kept.columns == columns, name
    n = kept.count()
    assert 0 < n < docs.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, SF001)
    assert pieces.select("doc_id").distinct().count() == kept.select("doc_id").distinct().count()


def test_pipeline_handles_hard_rows(spark):
    long = " ".join(f"w{i}" for i in range(20_000))
    rows = [(1, None, None, None, None), (None, "a b c d e f", "en", "s", 11), (2, "", "en", "s", 0), (3, long, "en", "s", len(long)), (3, long, "en", "s", len(long)), (4, "password=abcdefghijklmnop here", "en", "s", 30)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, score int")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF001)
    got = {r["doc_id"]: r for r in docs.collect()}
    assert set(got) == {1, None, 2, 3, 4} and docs.count() == 5
    assert got[4]["text"] == "[secret] here" and got[4]["n_chars"] == 13 and got[1]["text"] is None
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), SF001)
        assert empty.count() == 0


def test_pipeline_matches_brute_force(spark):
    """Plain Python over sf0.001: the same trained scores, pairwise n-gram sets,
    full alignments without seeds, redaction and tokens of what is left."""
    table = lambda n: spark.read.parquet(f"{SF001}/{n}.parquet")
    docs = {r["doc_id"]: r["text"] or "" for r in table("documents").collect()}
    model = queries.toxicity_model(table("documents"), table("labels"))
    scores = toxicity.score_texts(list(docs.values()), model)
    docs = {i: t for (i, t), s in zip(docs.items(), scores, strict=True) if s < 0.5}
    ids = sorted(docs)
    _, group = brute_links([docs[i] for i in ids])
    empty = [not re.search(r"[^\W_]", docs[i]) for i in ids]
    docs = {i: docs[i] for n, i in enumerate(ids) if group[n] == n or empty[n]}
    items = [textvec.words([r["text"]]).hashes for r in table("benchmark").collect()]
    leaked = lambda t: any(len(w) and decontaminate.align(w, textvec.words([t]).hashes)[0] >= 0.6 * 2 * len(w) for w in items)
    docs = {i: t for i, t in docs.items() if not leaked(t)}
    docs = {i: credentials.redact_text(t, credentials.scan_text(t, 200), "[secret]") for i, t in docs.items()}

    got = {}
    for r in corpus_pipeline.run(spark, SF001).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert set(got) == set(docs)
    encode = packing.encoder(packing.default_ranks()).encode_ordinary
    for i, t in docs.items():
        tokens = [*encode(t), 0]
        at = 0
        for r in sorted(got[i], key=lambda r: r["start"]):
            piece = np.array(tokens[r["start"] : r["start"] + r["length"]], dtype="<u4").tobytes()
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(piece) and r["doc_tokens"] == len(tokens)
            at += r["length"]
        assert at == len(tokens)
