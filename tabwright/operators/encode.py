"""Encoders: ordinal codes (E1, E6, W11), one-hot (E2, E5, F11), dictionary vectors (E3),
mixed mappers (E4), neighbour-mean target features (E7 via rank.knn)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.scalar import onehot_string
from tabwright.operators.rank import row_number_by


def ordinal_codes(values: DataFrame, c: str, out: str | None = None, base: int = 0) -> DataFrame:
    """Position of each distinct value of ``c`` in sorted order (``base``-based).

    The distinct list is ranked with the distributed row number, so a high-cardinality
    column never funnels through one task.
    """
    out = out or f"{c}_code"
    distinct = values.select(c).where(F.col(c).isNotNull()).distinct()
    ranked = row_number_by(distinct, [c], out="_rn")
    return ranked.select(c, (F.col("_rn") - 1 + base).cast("int").alias(out))


def label_encode(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None, base: int = 0,
                 suffix: str = "_code") -> DataFrame:
    """Replace each column by its code; codes are fitted on ``fit_on`` (default: ``df``).
    Values unseen at fit time get NULL.  Dictionaries join back by value (AQE broadcasts
    them when small, shuffles otherwise)."""
    fit_on = fit_on if fit_on is not None else df
    out = df
    for c in cols:
        codes = ordinal_codes(fit_on, c, f"{c}{suffix}", base).withColumnRenamed(c, f"_v_{c}")
        out = out.join(codes, out[c].eqNullSafe(codes[f"_v_{c}"]), "left").drop(f"_v_{c}")
    return out


def with_cardinality(codes: DataFrame, code_col: str, out: str = "n_values") -> DataFrame:
    """Attach the dictionary size (one-row scalar subquery) to a code table."""
    n = codes.agg(F.max(code_col) + 1).scalar()
    return codes.withColumn(out, n)


def onehot_columns(df: DataFrame, code_col: str, n_values: int, prefix: str) -> DataFrame:
    """E2 in relational form: one 0/1 column per code."""
    return df.select("*", *[(F.col(code_col) == i).cast("int").alias(f"{prefix}_{i}") for i in range(n_values)])


def zscore(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None, suffix: str = "_z") -> DataFrame:
    """Standardise with mean and population std of ``fit_on`` rows only (scalar subqueries)."""
    fit_on = fit_on if fit_on is not None else df
    out = df
    for c in cols:
        m = fit_on.agg(F.avg(c)).scalar()
        s = fit_on.agg(F.stddev_pop(c)).scalar()
        out = out.withColumn(f"{c}{suffix}", (F.col(c) - m) / F.nullif(s, F.lit(0.0)))
    return out


def pair_encode(pairs: DataFrame, categorical: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """E5: each categorical column as its one-hot string against the sorted list of its values, each numeric one over its
    maximum.  A string is as long as its dictionary, so dictionaries are small (n values are n * n characters): they go
    to the rows, which never meet in one task by their value.  ``pairs`` is written once."""
    pairs = pairs.checkpoint(eager=True)
    out = pairs
    for c in categorical:
        codes = ordinal_codes(pairs, c, "_pos").withColumnRenamed(c, "_value")
        n = codes.agg(F.count(F.lit(1))).scalar()
        # the string is made once a value, not once a row
        strings = codes.withColumn("_n", n).select("_value", onehot_string("_pos", "_n").alias("_hot"))
        out = out.join(F.broadcast(strings), out[c] == strings["_value"]).drop(c, "_value").withColumnRenamed("_hot", c)
    for c in numeric:
        out = out.withColumn(c, F.col(c) / pairs.agg(F.max(c)).scalar())
    return out


def sparse_onehot(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """One-hot of every column after label encoding, as the sorted list of active indices
    (column ``j`` occupies ``[offset_j, offset_j + cardinality_j)``).  Width never has to be
    known on the driver; offsets are scalar subqueries."""
    coded = label_encode(df.select(key, *cols), cols)
    offset = F.lit(0)
    idx = []
    for c in cols:
        idx.append((offset + F.col(f"{c}_code")).cast("int"))
        offset = offset + coded.agg(F.max(f"{c}_code") + 1).scalar()
    return coded.select(key, F.array(*idx).alias("active"))


def dict_vectorize(train: DataFrame, apply_to: DataFrame, key: str, categorical: Sequence[str],
                   numeric: Sequence[str]) -> DataFrame:
    """Dictionary vectoriser in long form ``(key, feature, value)``: string columns become
    ``col=value`` indicators (vocabulary fitted on ``train``; unseen values dropped), numeric
    columns pass through under their own name."""
    def longform(df):
        parts = [df.select(key, F.concat(F.lit(f"{c}="), F.col(c)).alias("feature"), F.lit(1.0).alias("value"))
                 for c in categorical]
        parts += [df.select(key, F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in numeric]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    vocab = longform(train).select("feature").distinct()
    return longform(apply_to).join(vocab, "feature", "left_semi")
