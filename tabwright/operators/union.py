"""Feature blocks side by side: a named union with a manifest (T12, T16) and the standardised query x document block."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators import blocks as BL
from tabwright.operators.rank import row_number_by
from tabwright.operators.textfeat import top_terms


def counted(tf: DataFrame, key: str) -> DataFrame:
    """A bag of words as a block: (key, feature, value)."""
    return tf.select(key, F.col("term").alias("feature"), F.col("tf").cast("double").alias("value"))


def single(df: DataFrame, key: str, name: str, value) -> DataFrame:
    """One number a row as a block; 0 and null are left out, as in any block."""
    return df.select(key, F.lit(name).alias("feature"), value.cast("double").alias("value")).where("value <> 0")


class FeatureUnion:
    """Named blocks (key, feature, value) whose columns stand one block behind the other.

    ``fit`` reads the training rows' blocks once and keeps the manifest (part, place, feature, column): a block's
    features in order of their names, at most ``limits[part]`` of them (the most frequent ones, ties by name).
    ``transform`` gives rows of any blocks of the same names their columns by that manifest, so train and test
    agree and features unseen in training are left out.  The manifest grows with the vocabulary and stays a table."""

    def __init__(self, parts: Sequence[str], key: str, limits: dict[str, int] | None = None):
        self.parts, self.key, self.limits, self.manifest = list(parts), key, limits or {}, None

    def _stacked(self, blocks: dict[str, DataFrame]) -> DataFrame:
        each = [blocks[p].select(self.key, F.lit(i).alias("part"), "feature", "value") for i, p in enumerate(self.parts)]
        return reduce(DataFrame.unionByName, each)

    def fit(self, blocks: dict[str, DataFrame]) -> FeatureUnion:
        kept = []
        for i, p in enumerate(self.parts):
            total = blocks[p].select(F.col("feature").alias("term"), F.col("value").alias("tf"))
            names = top_terms(total, self.limits[p]).select("term") if p in self.limits else total.select("term").distinct()
            kept.append(names.select(F.lit(i).alias("part"), F.col("term").alias("feature")))
        ranked = row_number_by(reduce(DataFrame.unionByName, kept), ["part", "feature"], out="column")
        self.manifest = BL.stored(ranked.withColumn("column", F.col("column") - 1))  # a small one meets the rows where they are
        return self

    def offsets(self) -> DataFrame:
        """(part, name, first column, columns): one row a block."""
        per = self.manifest.groupBy("part").agg(F.min("column").alias("offset"), F.count(F.lit(1)).alias("width"))
        return per.select(F.element_at(F.array(*[F.lit(p) for p in self.parts]), F.col("part") + 1).alias("name"), "offset", "width")

    def transform(self, blocks: dict[str, DataFrame]) -> DataFrame:
        """(key, columns array<long>, values array<double>): a sparse row, columns ascending; at most a row's own entries."""
        met = self._stacked(blocks).join(self.manifest, ["part", "feature"])
        rows = met.groupBy(self.key).agg(F.array_sort(F.collect_list(F.struct("column", "value"))).alias("_e"))
        return rows.select(self.key, F.col("_e.column").alias("columns"), F.col("_e.value").alias("values"))


def standard_block(values: DataFrame, row: str, column: str, value: str, rows) -> tuple[DataFrame, DataFrame]:
    """A sparse (row, column, value) block with columns standardised over all ``rows`` rows, zeros included.

    Returns the block's entries with ``z`` and the columns (column, n, mean, sd, shift).  Mean and standard deviation come
    from the entries and the row count; an absent entry stands at ``shift`` = -mean / sd, kept once a column and
    never written out, so nothing of rows x columns size exists.  A column without spread has z = shift = 0."""
    v = F.col(value).cast("double")
    cols = values.groupBy(column).agg(F.count(F.lit(1)).alias("n"), (F.sum(v) / rows).alias("mean"), F.sum(v).alias("_s"), F.sum(v * v).alias("_q"))
    sd = F.sqrt(F.greatest(F.col("_q") / rows - F.col("mean") * F.col("mean"), F.lit(0.0)))
    cols = cols.withColumn("sd", F.when(sd > 1e-12, sd)).withColumn("shift", F.coalesce(-F.col("mean") / F.col("sd"), F.lit(0.0)))
    cols = cols.select(column, "n", "mean", "sd", "shift")
    z = F.coalesce((v - F.col("mean")) / F.col("sd"), F.lit(0.0))
    return values.join(cols, column).select(row, column, z.alias("z")), cols


def dense_rows(entries: DataFrame, columns: DataFrame, rows: DataFrame, row: str, column: str, which: Sequence) -> DataFrame:
    """(row, column, z) with every entry of the few columns ``which`` written out."""
    grid = rows.select(row).withColumn(column, F.explode(F.array(*[F.lit(c).cast(columns.schema[column].dataType) for c in which])))
    shifts = columns.where(F.col(column).isin(list(which))).select(column, "shift")
    return grid.join(shifts, column).join(entries, [row, column], "left").select(row, column, F.coalesce("z", "shift").alias("z"))
