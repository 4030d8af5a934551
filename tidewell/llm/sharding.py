"""Reproducible shuffle into shards by a Feistel permutation with cycle walking over global row numbers.

Rows get global numbers 0..n-1 in the order of md5(id:CRC of the text): one scan counts rows by the first four hex
digits of that hash, the counts' running sum gives each of the 65,536 ranges its first number, and a window numbers
the rows inside a range. A Feistel network over Z_a x Z_b with a * b just above n permutes the numbers; results
beyond n walk the cycle until they come back. Position p is slot p div shards of shard p mod shards, so shard
sizes differ by one row at most and a row's place is computable from its number alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.scratch import own, unused

ROUNDS = 6
#: Hex digits of the hash that name a range of row numbers.
RANGE_DIGITS = 4
#: Most steps of a cycle walk. Under sqrt(n) of the a * b points lie beyond n, so longer walks don't occur: for n over 1000 each step comes back with a chance over 0.96.
WALK = 48
#: Columns that shard_rows adds.
ADDED = ("size", "text_crc32", "row_number", "shard", "slot")


def domain(n: int) -> tuple[int, int]:
    """The sides a, b of the network for n rows: a * b >= n, by less than a."""
    a = max(1, math.isqrt(n))
    return a, max(1, -(-n // a))


def _digest(x: Column, step: int, seed: int) -> Column:
    """32 bits of md5('x:step:seed') as a number."""
    return F.conv(F.substring(F.md5(F.concat(x.cast("string"), F.lit(f":{step}:{seed}"))), 1, 8), 16, 10).cast("long")


def feistel(p: Column, n: int, seed: int) -> Column:
    """One pass of the network over 0..a*b-1."""
    a, b = domain(n)
    left, right = F.floor(p / b).cast("long"), F.pmod(p, F.lit(b))
    for step in range(ROUNDS):
        if step % 2 == 0:
            left = F.pmod(left + _digest(right, step, seed), F.lit(a))
        else:
            right = F.pmod(right + _digest(left, step, seed), F.lit(b))
    return left * b + right


def permute(p: Column, n: int, seed: int) -> Column:
    """Position of row number p among n rows."""
    once = feistel(p, n, seed)
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), once, lambda at, _: F.when(at < n, at).otherwise(feistel(at, n, seed)))
    walked = F.when(once < n, once).otherwise(walk)
    return F.when(walked < n, walked).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("long"))


def shard_rows(df: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 7) -> DataFrame:
    """df with size (UTF-8 bytes of the text plus 8), text_crc32, row_number, shard and slot.

    Law `rows`: counts of shards differ by one at most, slots are gapless from 0. The same rows and seed give the
    same result however the input is partitioned. Null ids count as the empty string; a null text has size 8 and
    the CRC of no bytes; rows equal in id and text may stand in either order, which no result shows. Columns of df
    named as in ADDED are replaced, all others stay whatever their names. An empty df gives an empty result. The
    order depends on id and text, so rows that share only one of them (no id, the same text) don't meet in one task.
    """
    text, ids = F.col(text_col), F.col(id_col)
    size, crc = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8, F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
    key = F.md5(F.concat_ws(":", F.coalesce(ids.cast("string"), F.lit("")), crc.cast("string")))
    name = {x: unused(df, f"_{x}") for x in ("key", "range", "rank", "below", "at")}
    c = {x: F.col(n) for x, n in name.items()}
    counts = df.select(F.substring(key, 1, RANGE_DIGITS).alias(name["range"])).groupBy(name["range"]).count()
    below = F.sum("count").over(Window.orderBy(name["range"]).rowsBetween(Window.unboundedPreceding, -1))
    ranges = counts.select(name["range"], F.coalesce(below, F.lit(0)).alias(name["below"]))
    n = df.count()
    kept = own(df.drop(*ADDED))
    rows = df.select(*kept, size.alias("size"), crc.alias("text_crc32"), key.alias(name["key"])).withColumn(name["range"], F.substring(c["key"], 1, RANGE_DIGITS))
    rank = F.row_number().over(Window.partitionBy(name["range"]).orderBy(name["key"], "size"))
    placed = rows.withColumn(name["rank"], rank).join(F.broadcast(ranges), name["range"])  # 16 ** RANGE_DIGITS rows at most
    placed = placed.withColumn("row_number", c["below"] + c["rank"] - 1)
    placed = placed.withColumn(name["at"], permute(F.col("row_number"), n, seed))
    placed = placed.withColumns({"shard": F.pmod(c["at"], F.lit(shards)).cast("int"), "slot": F.floor(c["at"] / shards).cast("long")})
    return placed.drop(*name.values())
