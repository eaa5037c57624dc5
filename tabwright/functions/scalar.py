"""Scalar column functions (F*, P2, P6–P10, F7, F11, F13)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def capped_bin(value, width: float = 10.0, n_bins: int = 4) -> Column:
    """Fixed-width bin with a ceiling: ``least(floor(v / width), n_bins - 1)``; NULL stays NULL
    (``least`` alone would skip the NULL and return the ceiling)."""
    v = col(value)
    return F.when(v.isNotNull(), F.least(F.floor(v / F.lit(width)), F.lit(n_bins - 1))).cast("int")


def bin_with_default(value, default, width: float = 10.0, n_bins: int = 4) -> Column:
    """P6 + P8: cast at use (``try_cast``: a failed cast is missing), bin, missing → ``default``
    (e.g. ``3 - class``)."""
    v = col(value).try_cast("double")
    return F.coalesce(capped_bin(v, width, n_bins), col(default)).cast("int")


def recode(c, mapping: Mapping, default=None) -> Column:
    """Dictionary recode through a literal map (unmapped → ``default``)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    out = F.try_element_at(m, col(c))
    return F.coalesce(out, F.lit(default)) if default is not None else out


def flag(c, value) -> Column:
    """Two-way partition ``x = c`` vs everything else (NULL falls in the else side)."""
    return F.coalesce(col(c) == F.lit(value), F.lit(False))


def threshold(c, cut: float = 0.5, strict: bool = False) -> Column:
    """P10: 0/1 at a cut-off (``>=`` by default, ``>`` when strict)."""
    cond = col(c) > F.lit(cut) if strict else col(c) >= F.lit(cut)
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def clamp0(c) -> Column:
    """Clamp below at zero."""
    return F.greatest(col(c), F.lit(0.0))


def hex_digit_parity(c) -> Column:
    """Parity of the last hex digit of ``md5(c)`` — a seeded coin that DuckDB reproduces."""
    return (F.instr(F.lit("0123456789abcdef"), F.substring(F.md5(col(c).cast("string")), 32, 1)) - 1) % 2


def md5_key(*parts) -> Column:
    """md5 of '-'-joined parts (deterministic shuffle/sort key, same string in DuckDB)."""
    return F.md5(F.concat_ws("-", *[col(p).cast("string") for p in parts]))


def day_index(ts, origin: str = "2024-01-01") -> Column:
    """Days since ``origin`` (TIMESTAMP_NTZ → date)."""
    return F.datediff(F.to_date(col(ts)), F.to_date(F.lit(origin)))


def week_of(ts, origin: str = "2024-01-01") -> Column:
    """F7 on timestamps: 1-based week number."""
    return (F.floor(day_index(ts, origin) / 7) + 1).cast("int")


def day_of(ts, origin: str = "2024-01-01") -> Column:
    """F7 on timestamps: 1-based day within the week."""
    return (day_index(ts, origin) % 7 + 1).cast("int")


def parse_date_code(code) -> tuple[Column, Column]:
    """F7 on codes ``w<W>d<D>``, any number of digits each."""
    c = col(code)
    return (F.regexp_extract(c, r"w(\d+)", 1).cast("int"),
            F.regexp_extract(c, r"d(\d+)", 1).cast("int"))


def parse_type_code(code) -> Column:
    """``v<T>`` → T."""
    return F.regexp_extract(col(code), r"v(\d+)", 1).cast("int")


def onehot_string(pos, n) -> Column:
    """one-hot of a 0-based position among ``n`` sorted values, as a space-joined string."""
    return F.array_join(
        F.transform(F.sequence(F.lit(0), col(n) - 1), lambda i: F.when(i == col(pos), "1").otherwise("0")), " ")


def onehot_array(pos, n) -> Column:
    """the same one-hot as ``array<int>``."""
    return F.transform(F.sequence(F.lit(0), col(n) - 1), lambda i: (i == col(pos)).cast("int"))


def slot_sum(arr, start: int, length: int) -> Column:
    """sum of ``slice(arr, start, length)`` (1-based start)."""
    return F.aggregate(F.slice(col(arr), start, length), F.lit(0).cast("long"), lambda a, x: a + x)


def strided(arr, offset: int, stride: int = 7) -> Column:
    """every ``stride``-th element starting at 0-based ``offset``."""
    return F.filter(col(arr), lambda x, i: i % stride == offset)


def argmax_index(arr) -> Column:
    """0-based index of the first maximum of an array."""
    return F.array_position(col(arr), F.array_max(col(arr))) - 1


def round_half_even(c, digits: int = 0) -> Column:
    return F.bround(col(c), digits)


def first_non_null(cols: Sequence) -> Column:
    return F.coalesce(*[col(c) for c in cols])


def low_variance(var_col, max_var: float = 0.5) -> Column:
    """The (optional) low-variance row filter predicate ``var < max_var``."""
    return col(var_col) < F.lit(max_var)
