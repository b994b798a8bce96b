"""A Bloom filter as a small table: which rows of a large side can have a partner at all.

``build`` writes the keys' bits into blocks of 32,768 (``bitmap_construct_agg``, 4 KB each); all bits of a key lie in
one block, so ``possible`` needs one broadcast join on the block's number and a few bit tests, no Python.
No key is ever missed; about 1 % of the others pass at ``BITS`` a key, so an exact join must follow.

The blocks are at most ``MAX_BLOCKS`` (32 MB), which bounds the broadcast. More keys than 26 million share
them and more of the others pass; the rows that come out of the exact join are the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 32_768  # the length of bitmap_construct_agg's bitmaps
BITS = 10
HASHES = 5
MAX_BLOCKS = 8_192


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _positions(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BLOCK_BITS)) for i in range(HASHES)]


def blocks_for(keys: int) -> int:
    return min(MAX_BLOCKS, max(1, -(-keys * BITS // BLOCK_BITS)))


def build(keys: DataFrame, field: str, blocks: int) -> DataFrame:
    """(block, bits) of the non-null values of ``field``; values that repeat change nothing."""
    key = F.col(field)
    each = keys.where(key.isNotNull()).select(_block(key, blocks).alias("block"), F.explode(F.array(*_positions(key))).alias("at"))
    return each.groupBy("block").agg(F.bitmap_construct_agg("at").alias("bits"))


def possible(rows: DataFrame, field: str, bits: DataFrame, blocks: int) -> DataFrame:
    """The rows whose ``field`` may be among the keys, each once, with the columns that they had; null never is."""
    names = {c.lower() for c in rows.columns}
    block, bitmap = (next(n for n in (f"{c}{'_' * i}" for i in range(len(names) + 1)) if n not in names) for c in ("_block", "_bits"))
    key = rows[field]
    held = F.broadcast(bits.select(F.col("block").alias(block), F.col("bits").alias(bitmap)))
    known = rows.where(key.isNotNull()).join(held, _block(key, blocks) == F.col(block))
    for at in _positions(key):
        byte = F.conv(F.hex(F.substring(bitmap, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        known = known.where(F.getbit(byte, (at % 8).cast("int")) == 1)
    return known.drop(block, bitmap)


def marked(rows: DataFrame, key: Column, bits: DataFrame, blocks: int, name: str) -> DataFrame:
    """Every row once, with ``name``: whether ``key``, of the rows, may be among the keys (null never is)."""
    names = {c.lower() for c in rows.columns}
    block, bitmap = (next(n for n in (f"{c}{'_' * i}" for i in range(len(names) + 1)) if n not in names) for c in ("_block", "_bits"))
    held = F.broadcast(bits.select(F.col("block").alias(block), F.col("bits").alias(bitmap)))
    may = F.lit(True)
    for at in _positions(key):
        byte = F.conv(F.hex(F.substring(bitmap, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        may = may & (F.getbit(byte, (at % 8).cast("int")) == 1)
    known = rows.join(held, _block(key, blocks) == F.col(block), "left")
    return known.withColumn(name, key.isNotNull() & F.coalesce(may, F.lit(False))).drop(block, bitmap)
