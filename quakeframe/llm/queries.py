"""Queries over the text tables, and the SQL that DuckDB can check them with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeframe.llm import ann, audit, bpe, decontaminate, fim, jaccard, langid, licenses, lm, secrets, shards, toxicity, urls
from quakeframe.llm.words import key_fold


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, keep_text=False)
    return bpe.decode(coded).select("doc_id", "n_tokens", F.sha2("ids_le", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda x: x["rank"] < len(secrets.BASE_RULES))
    counts = [F.expr(f"cast(size(filter(secrets, x -> x.kind = '{r.kind}')) as long)").alias(f"n_{r.kind}") for r in secrets.BASE_RULES]
    return found.select("doc_id", *counts, F.sha2(secrets.as_text(base), 256).alias("base_sha256"), secrets.as_text(F.col("secrets")).alias("spans"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic").where(key_fold() != 2)
    scored = toxicity.predict(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", F.coalesce(key_fold() == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item: doc_id, the item and the similarity of the best window."""
    found = decontaminate.find(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    return found.where(F.size("matches") > 0).select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    starts = F.transform("places", lambda x: x["at"].cast("long"))
    base = F.transform("places", lambda x: x["label"])
    more = F.transform("found", lambda x: x["label"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, more))), ",").alias("labels"),
        "score",
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fitted = langid.fit(docs.where(key_fold() != 2))
    scored = langid.predict(docs.select("doc_id", "text"), fitted)
    return scored.select("doc_id", F.coalesce(key_fold() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(_table(spark, sf_dir, "documents").select("doc_id", "text"), size=4, percent=85)


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents that labels mark as of good quality; background: all documents."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    good = _table(spark, sf_dir, "labels").where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality")).where("quality = 1").select("doc_id")
    good = F.broadcast(good) if good.count() <= toxicity.BROADCAST_LABELS else good
    rows = docs.join(good.withColumn("target", F.lit(True)), "doc_id", "left").select("doc_id", "text", "target")
    return lm.score_corpus(rows)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_documents(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), _table(spark, sf_dir, "labels"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    restored = fim.restore(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard(_table(spark, sf_dir, "documents").select("doc_id", "text"), 16)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_url_filter": op1_url_filter, "op2_byte_bpe": op2_byte_bpe, "op3_secret_scan": op3_secret_scan, "op4_toxicity": op4_toxicity, "op5_decontaminate": op5_decontaminate, "op6_license_scan": op6_license_scan, "op7_language_id": op7_language_id, "op8_jaccard_join": op8_jaccard_join, "op9_nearest": op9_nearest, "op10_lm_score": op10_lm_score, "op11_filter_audit": op11_filter_audit, "op12_fill_in_middle": op12_fill_in_middle, "op13_sharding": op13_sharding}


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": urls.duckdb_sql(), "op3_secret_scan": secrets.duckdb_sql(), "op8_jaccard_join": jaccard.duckdb_sql(4, 85), "op11_filter_audit": audit.duckdb_sql(), "op12_fill_in_middle": fim.duckdb_sql(), "op13_sharding": shards.duckdb_sql()}
