"""Entity matching through shared tokens.

Sets are kept exploded as ``(entity_id, token[, attr])`` rows.  The set-overlap join is a
token equi-join followed by a partial+final count per pair.  A token held by a large share of
the entities on both sides is the skew case: such *hot* tokens are found from a degree table
(the heaviest ``max_hot`` of them, so the broadcast list has a fixed bound) and salted — the left
side's rows are spread over ``salt_buckets`` by a hash of the entity, the right side's rows of the
same token are replicated once per bucket — so no single task joins a whole hot token.  Nothing
is dropped; the pair list is the operator's output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def suffix_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
                suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Equi-join; shared non-key column names get ``_x`` / ``_y`` suffixes."""
    shared = (set(left.columns) & set(right.columns)) - set(on)
    lx = left.select(*[F.col(c).alias(c + suffixes[0]) if c in shared else F.col(c) for c in left.columns])
    ry = right.select(*[F.col(c).alias(c + suffixes[1]) if c in shared else F.col(c) for c in right.columns])
    return lx.join(ry, list(on), how)


def tokens_of(entities: DataFrame, entity: str, token_rows: DataFrame, key: str, token: str,
              attr: str | None = None) -> DataFrame:
    """Exploded, de-duplicated ``(entity_id, token[, attr])`` rows for a set of entities."""
    cols = [F.col(token).alias("token")] + ([F.col(attr).alias("attr")] if attr else [])
    t = token_rows.select(F.col(key).alias("entity_id"), *cols)
    e = entities.select(F.col(entity).alias("entity_id"))
    return t.join(e, "entity_id", "left_semi").distinct()


def token_set_string(tokens: DataFrame) -> DataFrame:
    """D5 producer: ``a b|c d`` per entity, items sorted (bounded by the entity's own set)."""
    item = F.concat_ws(" ", F.col("token").cast("string"), F.col("attr").cast("string"))
    return tokens.groupBy("entity_id").agg(F.array_join(F.array_sort(F.collect_set(item)), "|").alias("items"))


def parse_token_set(items_col: str = "items"):
    """D5 consumer: ``a b|c d`` → ``array<struct<token, attr>>`` (exploded by the caller)."""
    return F.transform(F.split(F.col(items_col), r"\|"),
                       lambda s: F.struct(F.split(s, " ")[0].alias("token"), F.split(s, " ")[1].alias("attr")))


def overlap_join(left: DataFrame, right: DataFrame, salt_buckets: int = 64) -> DataFrame:
    """Token equi-join rows ``(left_id, right_id, token)``, the same way for every token.

    The left rows of a token are spread over ``salt_buckets`` slots; the right rows go to the slots
    that exist, so a rare token is copied once per left row at most (no more than its pairs) and a
    token of any weight is worked on in that many pieces, which AQE may split further."""
    lt = left.select(F.col("entity_id").alias("left_id"), "token",
                     F.pmod(F.xxhash64("entity_id"), F.lit(salt_buckets)).cast("int").alias("_salt"))
    slots = lt.select("token", "_salt").distinct()
    rt = right.select(F.col("entity_id").alias("right_id"), "token").join(slots, "token")
    return lt.join(rt, ["token", "_salt"]).drop("_salt")


def with_attr_tokens(tokens: DataFrame, attrs: DataFrame, attr: str) -> DataFrame:
    """Tokens that agree only within one value of ``attr``: token = (attr, token), once for each value an entity has.

    Entities without a value have no token: they are in no pair of equal values."""
    known = attrs.where(F.col(attr).isNotNull()).select("entity_id", F.col(attr).alias("_a")).distinct()
    return tokens.join(known, "entity_id").select("entity_id", F.struct("_a", "token").alias("token")).where("token.token IS NOT NULL")


def overlap_pairs(left: DataFrame, right: DataFrame, **kw) -> DataFrame:
    """Every (left, right) with a non-empty token intersection and its size."""
    return overlap_join(left.select("entity_id", "token").distinct(),
                        right.select("entity_id", "token").distinct(), **kw).groupBy(
        "left_id", "right_id").agg(F.count(F.lit(1)).alias("n_common"))


def first_overlap(left: DataFrame, right: DataFrame, order_col: str = "entity_id") -> DataFrame:
    """Per left entity, the first right entity (smallest ``order_col``) sharing a token.

    No pairs are formed: the smallest right id per token is a group-by, and each left
    entity takes the minimum over its own tokens."""
    first_by_token = right.groupBy("token").agg(F.min(order_col).alias("right_id"))
    return left.select("entity_id", "token").join(first_by_token, "token").groupBy(
        F.col("entity_id").alias("left_id")).agg(F.min("right_id").alias("right_id"))


def common_count(pairs: DataFrame, left: DataFrame, right: DataFrame, flagged: DataFrame | None = None) -> DataFrame:
    """For given candidate pairs, the number of common tokens (zeros kept) and, when a
    flagged-token table is given, the number of flagged common tokens.

    Tokens are joined per pair side (each pair's work is bounded by its own two sets)."""
    lt = pairs.join(left.select(F.col("entity_id").alias("left_id"), "token"), "left_id")
    both = lt.join(right.select(F.col("entity_id").alias("right_id"), "token"), ["right_id", "token"])
    if flagged is not None:
        both = both.join(flagged.select("token", F.lit(1).alias("_f")), "token", "left")
        aggs = [F.count(F.lit(1)).alias("n_common"), F.count("_f").alias("n_flagged")]
    else:
        aggs = [F.count(F.lit(1)).alias("n_common")]
    cnt = both.groupBy("left_id", "right_id").agg(*aggs)
    out = pairs.join(cnt, ["left_id", "right_id"], "left").fillna(0, ["n_common"])
    return out.fillna(0, ["n_flagged"]) if flagged is not None else out


def count_flagged(entities: DataFrame, tokens: DataFrame, flagged: DataFrame) -> DataFrame:
    """Per entity, its number of tokens and of flagged tokens (entities without any kept with 0)."""
    t = tokens.select("entity_id", "token").join(flagged.select("token", F.lit(1).alias("_f")), "token", "left")
    per = t.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n_tokens"), F.count("_f").alias("n_flagged"))
    return entities.select("entity_id").join(per, "entity_id", "left").fillna(0, ["n_tokens", "n_flagged"])


def same_attr_filter(pairs: DataFrame, left_attr: DataFrame, right_attr: DataFrame, attr: str) -> DataFrame:
    """Keep pairs whose looked-up attribute is equal on both sides."""
    la = left_attr.select(F.col("entity_id").alias("left_id"), F.col(attr).alias("_la"))
    ra = right_attr.select(F.col("entity_id").alias("right_id"), F.col(attr).alias("_ra"))
    return pairs.join(la, "left_id").join(ra, "right_id").where(F.col("_la") == F.col("_ra")).drop("_la", "_ra")


def match_lists(left_entities: DataFrame, pairs: DataFrame) -> DataFrame:
    """K3: per left entity the sorted, space-joined list of matched right ids; no match → empty string."""
    lists = pairs.groupBy("left_id").agg(
        F.array_join(F.array_sort(F.collect_list(F.col("right_id").cast("long"))), " ").alias("matches"))
    return left_entities.select(F.col("entity_id").alias("left_id")).join(lists, "left_id", "left").fillna(
        "", ["matches"])


def route_merge(stream: DataFrame, key: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Route each attribute row to whichever table holds its id.

    The tables are tagged and unioned, then joined to the stream once (sort-merge on id);
    rows whose id is in no table come out with ``kind = NULL`` instead of being lost."""
    tagged = None
    for kind, t in tables.items():
        part = t.select(F.col("entity_id"), F.lit(kind).alias("kind"))
        tagged = part if tagged is None else tagged.unionByName(part)
    return stream.join(tagged, stream[key] == tagged["entity_id"], "left").drop("entity_id")
