"""Registered queries of the training-data operators: each applies its operator
to its whole table and derives the result columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardwise.llm import ann, chosen_path, credentials, decontaminate, html_text, licenses, ngram_join, oracles, packing, periodic_runs, sharding, signature_search, toxicity, url_filter
from shardwise.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op5_sharding")
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs, shards=24).withColumn("grown_shard", F.lit(None).cast("int"))


@register("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def held_out(doc_id):
    """The fifth of the ids whose labels are never learnt."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    return toxicity.train(docs, labels, keep=lambda i: ~held_out(i))


@register("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    out = toxicity.score(docs, model, out="score")
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op9_secrets")
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = credentials.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secrets")
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("secrets", lambda s: s["kind"].isin(*credentials.BASE_KINDS))
    count = lambda k: F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in credentials.BASE_KINDS], F.sha2(spans(base).cast("binary"), 256).alias("base_sha256"), spans(F.col("secrets")).alias("spans"))


@register("op4_licenses", oracles.licenses_sql())
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    at = lambda f: F.transform("base", lambda b: b["at"][f])
    names = F.transform("base", lambda b: b["label"])
    labels = F.concat(names, F.transform("detections", lambda d: d["label"]))
    join = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return found.select(
        "doc_id", "n_words", F.aggregate(at("n"), F.lit(0).cast("long"), lambda a, x: a + x).alias("n_base"),
        F.array_min(at("first")).alias("first_word"), F.array_max(at("last")).alias("last_word"),
        join(names).alias("base_labels"), join(labels).alias("labels"), "score")


@register("op3_url_filter", oracles.url_filter_sql())
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("lm_score", 6).alias("lm_score"))


@register("op10_html_text")
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = html_text.extract(pages, html_text.train(pages))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@register("op7_decontamination")
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.find(docs, table(spark, sf_dir, "benchmark"))


@register("op2_ngram_join", oracles.ngram_join_sql())
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op1_nearest")
def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@register("op11_chosen_path", oracles.chosen_path_sql())
def op11_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op12_signature_search", oracles.signature_search_sql())
def op12_signature_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = signature_search.search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


def with_periodic_texts(docs: DataFrame) -> DataFrame:
    """Documents whose crc32(doc_id) ends in 0 repeat a stretch of their words
    from a place on, both given by the other digits."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size("ws")
    ws = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "")
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, ws).alias("ws"), g.alias("g"))
    a = (F.col("g") % n).cast("int")
    places = chosen.withColumns({"a": F.when(n > 0, a), "n": n}).withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    made = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("ws", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))))
    return places.select("doc_id", F.when(F.col("n") > 0, F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))


@register("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_periodic_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.find(docs)
    # greatest length / period first: compared by cross products, then smallest start, then period
    ahead = lambda x, y: x["length"] * y["period"] - y["length"] * x["period"]
    best = F.aggregate(F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.get("runs", F.lit(0)), lambda b, r: F.when(ahead(r, b) > 0, r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return found.select("*", best.alias("best")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"), sha(lines).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256"))
