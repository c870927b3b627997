"""The corpus pipeline over documents: five stages, each a table that the next one reads.

Stages 1 to 4 return the columns of documents, whatever they are called and
further ones too; rows that stay are never changed but by stage 4. Null texts have
no language and go in stage 1. The Jaccard stage keeps one row of each group of
near copies, of the row with the smallest doc_id (of rows with the same doc_id, the
one with the smallest hash of its text, then of the whole row); rows with a null
doc_id are no part of a group and stay, and so do texts without words, once a
doc_id. Documents that hold a benchmark item go; secrets are cut out of the texts
of documents, which stay, and n_chars follows. The last stage returns the digests
of the encoded and decoded text, a row for each that is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeframe.llm import bpe, decontaminate, jaccard, langid, secrets
from quakeframe.llm.words import key_fold
from quakeframe.session import materialize

#: Texts whose best language is less likely than this are rejected.
LEAST_SCORE = 0.5


def _apart(docs: DataFrame, *used: str) -> tuple[DataFrame, list[str]]:
    """docs with the columns not in used under names that no operator uses, and those names."""
    names = [c if c in used else f"__own_{k}" for k, c in enumerate(docs.columns)]
    return docs.toDF(*names), names


def _back(df: DataFrame, names: list[str], docs: DataFrame) -> DataFrame:
    return df.select(*names).toDF(*docs.columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    fitted = langid.fit(docs.where(key_fold() != 2))
    held, names = _apart(docs, "text")
    scored = langid.predict(held, fitted)
    return _back(scored.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)), names, docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    held, names = _apart(docs, "doc_id", "text")
    marked = held.withColumn("__mark", F.xxhash64("text"))
    groups = jaccard.components(marked.select("doc_id", "text", "__mark"), size=5, percent=80, mark="__mark").where("doc_id is not null")
    alone = F.when(F.col("group").isNull(), F.col("doc_id")).alias("alone")  # a text without words
    first = groups.groupBy("group", alone).agg(F.min(F.struct("doc_id", "__mark")).alias("first")).select("first.*")
    kept = marked.where("doc_id is not null").join(first, ["doc_id", "__mark"], "left_semi").withColumn("__row", F.xxhash64(*names))
    once = kept.withColumn("__copy", F.expr("row_number() over (partition by doc_id, __mark order by __row)")).where("__copy = 1")
    return _back(once.select(*names).unionByName(held.where("doc_id is null")), names, docs)


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    held, names = _apart(docs, "text")
    found = decontaminate.find(held, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _back(found.where(F.size("matches") == 0), names, docs)


def cut_out_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    held, names = _apart(docs, "doc_id", "text", "n_chars")
    found = secrets.scan(held)
    text = secrets.redact(F.col("text"), F.col("secrets"))
    has = F.size("secrets") > 0
    clean = found.withColumn("n_chars", F.when(has, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))).withColumn("text", text)
    return _back(clean, names, docs)


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe.decode(bpe.encode(docs.select("doc_id", "text"), keep_text=False))
    return coded.select("doc_id", "n_tokens", F.sha2("ids_le", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", keep_one_of_near_copies),
    ("decontaminate", remove_benchmark_leaks),
    ("secret_scan", cut_out_secrets),
    ("byte_bpe", encode_and_decode),
]
#: Segmentation sums and merges have no SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each one's rows are written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
