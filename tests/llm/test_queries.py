"""The registered queries: their columns, whole tables, and SQL where there is some."""

import duckdb
import pytest
from pyspark.sql import functions as F

from quakeframe.llm import queries
from quakeframe.llm.words import key_fold

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op2_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op3_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op4_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op5_decontaminate": ["doc_id", "item_id", "similarity"],
    "op6_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op7_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op8_jaccard_join": ["doc_id", "n_shingles", "component_id"],
    "op9_nearest": ["query_id", "rank", "vec_id", "score"],
    "op10_lm_score": ["doc_id", "n_tokens", "score"],
    "op11_filter_audit": ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"],
    "op12_fill_in_middle": ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
    "op13_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, name):
    got = queries.queries()[name](spark, SF)
    assert set(COLUMNS[name]) <= set(got.columns)
    rows = got.collect()
    sql = queries.oracle_sql().get(name)
    if sql:
        db = duckdb.connect()
        for t in ("documents", "pages", "labels"):
            db.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
        want = db.sql(sql)
        at = [want.columns.index(c) for c in got.columns]
        key = lambda r: tuple("" if v is None else str(v) for v in r)
        assert sorted(map(key, rows)) == sorted(key([r[k] for k in at]) for r in want.fetchall())
    elif "doc_id" in got.columns and name != "op5_decontaminate":
        assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_fold_is_crc32_of_the_id_as_text(spark):
    import zlib

    got = spark.range(50).select("id", key_fold("id").alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 4 for r in got)
    assert spark.createDataFrame([(None,)], "id long").select(F.coalesce(key_fold("id") == 2, F.lit(False)).alias("h")).first().h is False
