"""Sharding by jump consistent hashing (DataFrame functions only).

A stable 64-bit key (xxhash64 of the key columns) walks the published jump sequence
with a linear congruential generator; the last jump below the shard count is the shard.
No ring table exists, and appending a shard moves only the rows that enter it.  The
generator needs arithmetic modulo 2^64, which SQL does not have under ANSI rules, so the
state is kept in three limbs of 22, 22 and 20 bits whose products fit a bigint.

Defined results: a null key hashes to a fixed value and so has one shard; a null or empty
text has size 1 and CRC-32 0; rows with equal keys share a shard and get different slots;
an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import utf8_size, with_block_rank

_LCG = 2862933555777941757  # multiplier of the published algorithm; the increment is 1
_M22, _M20 = (1 << 22) - 1, (1 << 20) - 1
_L0, _L1, _L2 = _LCG & _M22, (_LCG >> 22) & _M22, _LCG >> 44
#: Jumps taken before the exact long walk; a key needs about ln(shards) of them.
_FIRST_JUMPS = 64


def _jump(state: Column, n: int) -> Column:
    """One step of the walk while the next bucket is below ``n``."""
    a0, a1, a2 = state["k0"], state["k1"], state["k2"]
    c0 = a0 * F.lit(_L0) + F.lit(1)
    c1 = a0 * F.lit(_L1) + a1 * F.lit(_L0) + F.shiftright(c0, 22)
    c2 = a0 * F.lit(_L2) + a1 * F.lit(_L1) + a2 * F.lit(_L0) + F.shiftright(c1, 22)
    k0, k1, k2 = c0.bitwiseAND(F.lit(_M22)), c1.bitwiseAND(F.lit(_M22)), c2.bitwiseAND(F.lit(_M20))
    top31 = F.shiftleft(k2, 11) + F.shiftright(k1, 11)  # the key shifted right by 33
    nxt = F.floor((state["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / (top31 + 1).cast("double"))).cast("long")
    moved = F.struct(state["j"].alias("b"), nxt.alias("j"), k0.alias("k0"), k1.alias("k1"), k2.alias("k2"))
    return F.when(state["j"] < n, moved).otherwise(state)


def jump_hash(key: Column, shards: int) -> Column:
    """Shard in [0, shards) of a bigint ``key``."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    start = F.struct(
        F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"),
        key.bitwiseAND(F.lit(_M22)).alias("k0"),
        F.shiftrightunsigned(key, 22).bitwiseAND(F.lit(_M22)).alias("k1"),
        F.shiftrightunsigned(key, 44).alias("k2"))
    walk = lambda init, steps: F.aggregate(F.sequence(F.lit(1), F.lit(steps)), init, lambda s, _: _jump(s, shards))
    first = walk(start, min(shards, _FIRST_JUMPS))
    if shards > _FIRST_JUMPS:  # each step moves on by one bucket at least, so `shards` steps always end the walk
        first = F.when(first["j"] >= shards, first).otherwise(walk(first, shards))
    return first["b"].cast("int")


def shard(df: DataFrame, key: Sequence[str], shards: int, text_col: str = "text", slot_blocks: int = 1024) -> DataFrame:
    """Rows of ``df`` with size, text_crc32, shard, grown_shard and a gapless slot inside the shard
    (columns of ``df`` with these names are replaced).

    Slots order a shard by (hash block, key): each of ``slot_blocks`` blocks of a shard is
    numbered by itself behind the blocks before it, so a shard of any size is spread."""
    hashed = F.xxhash64(*[F.col(k) for k in key])
    rows = (df.withColumn("size", utf8_size(F.col(text_col)) + 1)
            .withColumn("text_crc32", F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
            .withColumn("shard", jump_hash(hashed, shards))
            .withColumn("grown_shard", jump_hash(hashed, shards + 1)))
    block = F.pmod(F.xxhash64(*[F.col(k) for k in key], "text_crc32", "size"), F.lit(slot_blocks))
    return with_block_rank(rows, ["shard"], block, [*key, "text_crc32", "size"], "slot")


def shard_digest(docs: DataFrame, shards: int = 8) -> DataFrame:
    """The digest of the query: every document's shard under the law ``key``."""
    out = shard(docs.select("doc_id", "text"), ["doc_id"], shards)
    return out.select("doc_id", "size", F.col("text_crc32").cast("long"), F.lit("key").alias("law"), "shard", "slot",
                      "grown_shard")
