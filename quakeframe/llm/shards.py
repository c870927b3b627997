"""Shards of near equal size, contiguous in the order of ids.

Rows are dealt by ranges of (key, size, checksum); each range's total of bytes and rows is
carried to the ranges after it, over a table with a row a range, and within a
range a running sum adds what is before each row. A row belongs to the shard in
whose equal part of all bytes its middle lies, so each cut is off by half a row at most,
shards differ by one row's size at most (but for rows larger than a shard), and the rows of a
shard are neighbours in the order of the key. Texts are read once; only their sizes and
checksums are dealt. Expressions only.

A text's size is its bytes in UTF-8 and one more, so an empty or null text has size 1 and no row is free. Null keys
come first. Rows that are alike in key, size and checksum may stand in either order, which no result shows;
one key may hold any share of the rows, as sizes, checksums and a row number part them. Equal texts need not share a
shard, since a group of copies may be larger than any shard; with by_text they are neighbours in the order, and so share one unless a cut
falls between them. Further columns, also of the operator's own names, are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quakeframe.session import materialize


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long")) + 1


def text_crc32(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def prefix_sums(sized: DataFrame, order: list[str], size: str = "size") -> DataFrame:
    """Adds bytes_before, rows_before and total_bytes: sums over all rows before in order (sized is a written table)."""
    ranged = sized.repartitionByRange(*order).select("*", F.spark_partition_id().alias("__p"))
    placed = materialize(ranged, "ranges")  # narrow rows; sampling ranges anew may cut otherwise
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("__p").agg(F.sum(size).alias("b"), F.count(F.lit(1)).alias("r"))
    ranges = Window.orderBy("__p")  # a row a range
    carried = sums.select("__p", *(F.coalesce(F.sum(c).over(before(ranges)), F.lit(0)).alias(f"__{c}") for c in "br"), F.sum("b").over(ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total_bytes"))
    here = before(Window.partitionBy("__p").orderBy(*order))
    own = placed.select("*", F.coalesce(F.sum(size).over(here), F.lit(0)).alias("__own_b"), (F.row_number().over(Window.partitionBy("__p").orderBy(*order)) - 1).alias("__own_r"))
    joined = own.join(F.broadcast(carried), "__p")  # as many rows as the shuffle has partitions
    return joined.withColumns({"bytes_before": F.col("__b") + F.col("__own_b"), "rows_before": F.col("__r") + F.col("__own_r")}).drop("__p", "__b", "__r", "__own_b", "__own_r")


def shard_of(before: Column, size: Column, total: Column, shards: int) -> Column:
    """The equal part of all bytes in which the middle of a row lies; in decimals, since the product outgrows a long."""
    wide = lambda c: c.cast("decimal(38,0)")
    return F.floor(wide(2 * before + size) * F.lit(shards) / wide(2 * total)).cast("int")


def shard(df: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text", by_text: bool = False) -> DataFrame:
    """key, size, text_crc32, law, shard (from 0), slot (place in the shard, from 0) and grown_shard (null: another number of shards cuts anew).

    by_text orders by the text's checksum and hash first, so that copies are neighbours.
    """
    if shards < 1:
        raise ValueError("one shard at least")
    rows = df.select(F.col(key), text_size(F.col(text)).alias("size"), text_crc32(F.col(text)).alias("text_crc32"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("__hash"), F.monotonically_increasing_id().alias("__row"))
    rows = materialize(rows, "sizes")
    order = [*(["text_crc32", "__hash"] if by_text else []), key, "size", "text_crc32", "__row"]
    placed = prefix_sums(rows, list(dict.fromkeys(order)))
    placed = materialize(placed.withColumn("shard", shard_of(F.col("bytes_before"), F.col("size"), F.col("total_bytes"), shards)), "shards")
    first = placed.groupBy("shard").agg(F.min("rows_before").alias("__first"))  # a row a shard
    joined = placed.join(F.broadcast(first), "shard")
    return joined.select(key, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("rows_before") - F.col("__first")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def duckdb_sql(shards: int = 16) -> str:
    """Over documents; the checksum's table comes from its polynomial."""
    return f"""WITH table8 AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(range(0, 9), lambda c, k: CASE WHEN k = 0 THEN c WHEN c % 2 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END, i::BIGINT) AS c FROM range(0, 256) r(i))),
b AS (SELECT doc_id, list_transform(regexp_extract_all(hex(coalesce(text, '')), '..'), lambda x: ('0x' || x)::BIGINT) AS b FROM documents),
s AS (SELECT doc_id, CAST(len(b) + 1 AS BIGINT) AS size, CAST(xor(4294967295::BIGINT, list_reduce(b, lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8), 4294967295::BIGINT)) AS BIGINT) AS text_crc32 FROM b, table8),
p AS (SELECT *, coalesce(sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(size) OVER () AS total FROM s),
n AS (SELECT *, CAST((2 * before + size) * {shards} // (2 * total) AS INT) AS shard FROM p)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, CAST(row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS BIGINT) AS slot, CAST(NULL AS INT) AS grown_shard FROM n"""
