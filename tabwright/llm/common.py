"""Shared pieces: group values attached without a hot task, and gapless ranks in blocks.

Column names that begin with an underscore are the operators' own: where whole rows are handed on, a caller's column of
such a name may come back with the operator's value (``mixing.mixed_rows`` keeps them all)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwright.session import ensure_checkpoint_dir

#: ``[\x20\x09-\x0D]``: the white space of every contract in this package.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder the session names."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def same(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str = "_r_") -> Column:
    """Null-safe equality of ``keys`` with the right side's prefixed copies."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[prefix + k]) for k in keys])


def prefixed(df: DataFrame, keys: Sequence[str], prefix: str = "_r_") -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) if c in keys else F.col(c) for c in df.columns])


def with_group_values(rows: DataFrame, key: Sequence[str], salt_on: Sequence[str], parts: dict, wholes: dict,
                      salts: int = 64) -> DataFrame:
    """Attach per-group aggregates to every row of the group.

    A group may hold a third of all rows, so rows meet their group's values on
    (key, salt): ``parts`` (name -> aggregate over rows) are built per (key, salt),
    ``wholes`` (name -> aggregate over the parts) in a window of at most ``salts`` rows
    per key, and the (key, salt) pairs are joined back.  ``rows`` is evaluated twice: pass
    a materialised table when it is expensive.
    """
    key = list(key)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*salt_on), F.lit(salts)).cast("int"))
    part = salted.groupBy(*key, "_salt").agg(*[c.alias(n) for n, c in parts.items()])
    group = Window.partitionBy(*key)
    back = part.select(*[F.col(k).alias("_r_" + k) for k in key], F.col("_salt").alias("_r__salt"),
                       *[c.over(group).alias(n) for n, c in wholes.items()])
    return salted.join(back, same(salted, back, [*key, "_salt"])).select(*rows.columns, *wholes)


def attach(rows: DataFrame, table: DataFrame, key: Sequence[str], salt_on: Sequence[str], salts: int = 64,
           how: str = "inner") -> DataFrame:
    """Columns of ``table`` (one row per key) on every row, met on (key, salt): a hot key is spread.

    ``rows`` is evaluated twice."""
    key = list(key)
    extra = [c for c in table.columns if c not in key]
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*salt_on), F.lit(salts)).cast("int"))
    spots, t = salted.select(*key, "_salt").distinct(), prefixed(table, key)
    spots = spots.join(t, same(spots, t, key)).select(
        *[F.col(k).alias("_r_" + k) for k in key], F.col("_salt").alias("_r__salt"), *extra)
    return salted.join(spots, same(salted, spots, [*key, "_salt"]), how).select(*rows.columns, *extra)


def keep_one(docs: DataFrame, keys: dict, decided: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``keys`` (name -> expression) are not in ``decided`` (keys, _stays), and one row, the
    same in every run, of those it lists with ``_stays``: rows that repeat all keys."""
    decided, marked = materialise(prefixed(decided, list(keys))), docs.withColumns(keys)
    out = marked.join(decided, same(marked, decided, list(keys)), "left_anti").select(*docs.columns)
    again = decided.filter("_stays")
    if again.isEmpty():
        return out
    row = F.struct(*[docs[c] for c in docs.columns])
    rows = marked.join(again, same(marked, again, list(keys)), "left_semi").groupBy(*keys).agg(
        F.min_by(row, F.sha2(F.to_json(row), 256)).alias("_row"))
    return out.unionByName(rows.select("_row.*"))


def with_block_rank(rows: DataFrame, group: Sequence[str], block: Column, order: Sequence, out: str,
                    weight: Column | None = None, total: str | None = None) -> DataFrame:
    """0-based gapless position inside ``group``, ordered by (block, order).

    ``block`` cuts a group of any size into pieces that one task can sort; piece totals
    give each piece its offset, so no task ever sees a whole group.  With ``weight`` the
    result is the exclusive running sum of the weight instead of the position;
    ``total`` names a column for the group's total.  ``rows`` is evaluated twice.
    """
    group = list(group)
    w = F.lit(1).cast("long") if weight is None else weight
    rows_b = rows.withColumn("_block", block.cast("long")).withColumn("_w", w)
    sizes = rows_b.groupBy(*group, "_block").agg(F.sum("_w").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    extra = []
    if total:
        sizes, extra = sizes.withColumn(total, F.sum("_n").over(Window.partitionBy(*group))), [total]
    sizes = prefixed(sizes.drop("_n"), [*group, "_block"])
    inside = Window.partitionBy(*group, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = rows_b.join(sizes, same(rows_b, sizes, [*group, "_block"]))
    return joined.withColumn(out, F.col("_before") + F.coalesce(F.sum("_w").over(inside), F.lit(0))).select(
        *rows.columns, out, *extra)


def utf8_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
