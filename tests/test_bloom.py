"""The Bloom filter in front of the cache: nothing lost, little kept, the cache filtered before it is shuffled."""

import re

from pyspark.sql import functions as F

from flowlens.functions import bloom
from flowlens.operators import enrich as EN
from flowlens.schemas import IP, IP_INFO_SCHEMA, RESP_H

KEYS, OTHERS = 20_000, 200_000


def _ip(n):
    return F.concat_ws(".", F.lit("10"), F.floor(n / 65536), F.floor(n / 256) % 256, n % 256)


def test_no_key_is_missed_and_few_others_pass(spark):
    keys = spark.range(KEYS).select(_ip(F.col("id")).alias("k"))
    blocks = bloom.blocks_for(KEYS)
    bits = bloom.build(keys.union(keys.limit(100)), "k", blocks)
    assert blocks > 1 and bits.count() == blocks
    rows = spark.range(OTHERS).select("id", _ip(F.col("id")).alias("k"), F.lit(1).alias("_BITS"), F.lit(2).alias("block"))
    kept = bloom.possible(rows, "k", bits, blocks)
    assert kept.columns == rows.columns
    assert kept.where(F.col("id") < KEYS).count() == KEYS
    assert kept.where(F.col("id") >= KEYS).count() < 0.03 * (OTHERS - KEYS)


def test_too_many_keys_for_the_blocks_lose_nothing(spark):
    keys = spark.range(KEYS).select(_ip(F.col("id")).alias("k"))
    bits = bloom.build(keys, "k", 1)
    assert bloom.possible(keys, "k", bits, 1).count() == KEYS


def test_nulls_repeats_and_no_keys(spark):
    keys = spark.createDataFrame([("a",), (None,), ("",), ("a",)], "k string")
    bits = bloom.build(keys, "k", 1)
    rows = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("", 4)], "k string, n int")
    assert sorted(r.n for r in bloom.possible(rows, "k", bits, 1).collect()) == [1, 2, 4]
    none = bloom.build(keys.limit(0), "k", bloom.blocks_for(0))
    assert bloom.possible(rows, "k", none, 1).count() == 0 and bloom.possible(rows.limit(0), "k", bits, 1).count() == 0


def test_same_hits_and_misses_with_the_cache_filtered_before_its_shuffle(spark):
    hosts = spark.range(0, 4000, 2).select(_ip(F.col("id")).alias(RESP_H)).union(spark.createDataFrame([(None,)], f"{RESP_H} string"))
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in IP_INFO_SCHEMA if f.name != IP]
    cache = spark.range(1000, 60_000).select(_ip(F.col("id")).alias(IP), *blank).select(IP_INFO_SCHEMA.names)
    near = EN.possible_hits(cache, hosts)
    assert 1500 <= near.count() < 3500
    for plain, filtered in ((EN.cache_hits(cache, hosts), EN.cache_hits(near, hosts)), (EN.cache_misses(hosts, cache), EN.cache_misses(hosts, near))):
        assert sorted(map(str, plain.collect())) == sorted(map(str, filtered.collect()))
    assert EN.cache_misses(hosts, near).count() == 500
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = EN.cache_misses(hosts, near)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    cache_side = plan[plan.rindex("hashpartitioning(ID_RESP_H"):]
    assert "SortMergeJoin" in plan and re.search(r"BroadcastHashJoin .*_block", cache_side)  # below the exchange
