"""Text expressions shared by the text operators.

Regular expressions are written so that Java (Spark) and RE2 (DuckDB) agree: ``\\p{L}`` /
``\\p{N}`` instead of ``\\w`` (Java's ``\\w`` is ASCII-only), explicit ``(?is)`` flags.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabwright.functions.scalar import col

# The accented letters that occur in the corpus and their unaccented forms
# (``ß`` has no one-letter form and stays).
ACCENTED = "ÄÇÈÉÊÍÑÓÖÜäçèéêíñóöü"
UNACCENTED = "ACEEEINOOUaceeeinoou"

# HTML entities decoded by the markup remover, in decoding order (``&amp;`` last
# so that ``&amp;lt;`` becomes ``&lt;`` and not ``<``).
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]

# Default stop words (a compact English function-word list; pass your own list
# to any operator that takes ``stop_words``).
STOP_WORDS = ["a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he", "in", "is", "it",
              "its", "of", "on", "that", "the", "to", "was", "were", "will", "with", "this", "or", "but",
              "not", "which"]

WORD = r"[\p{L}\p{N}_]+"
WORD2 = r"[\p{L}\p{N}_]{2,}"


def fold_accents(c) -> Column:
    """Accent stripping by letter translation."""
    return F.translate(col(c), ACCENTED, UNACCENTED)


def strip_markup(c) -> Column:
    """Drop script/style bodies and comments, tags → space, decode entities, squeeze spaces."""
    s = F.regexp_replace(col(c), r"(?is)<script[^>]*>.*?</script>", " ")
    s = F.regexp_replace(s, r"(?is)<style[^>]*>.*?</style>", " ")
    s = F.regexp_replace(s, r"(?s)<!--.*?-->", " ")
    s = F.regexp_replace(s, r"(?s)<[^>]*>", " ")
    for ent, ch in ENTITIES:
        s = F.replace(s, F.lit(ent), F.lit(ch))
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def legacy_clean(c) -> Column:
    """T2 without stemming: non-alphanumerics → space, ``NNNpx`` and short numbers / ``000``
    removed, tokens of ≤ 2 characters dropped, lower-cased."""
    s = F.regexp_replace(col(c), r"[^a-zA-Z0-9]", " ")
    s = F.regexp_replace(s, r"[0-9]{1,3}px", " ")
    s = F.regexp_replace(s, r" [0-9]{1,6} |000", " ")
    toks = F.filter(F.split(s, " "), lambda t: F.length(t) > 2)
    return F.lower(F.array_join(toks, " "))


def min_length_default(c, default: str, min_len: int = 3) -> Column:
    """text shorter than ``min_len`` becomes a placeholder."""
    return F.when(F.length(col(c)) < min_len, F.lit(default)).otherwise(col(c))


def words(c, pattern: str = WORD, accents: bool = True) -> Column:
    """T5: lower-cased word tokens (accents folded first)."""
    s = fold_accents(c) if accents else col(c)
    return F.regexp_extract_all(F.lower(s), F.lit(pattern), 0)


def drop_stop(tokens, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    sw = F.array(*[F.lit(w) for w in stop_words])
    return F.filter(col(tokens), lambda t: ~F.array_contains(sw, t))


def ngrams(tokens, n: int) -> Column:
    """T5: space-joined n-grams of a token array (empty when shorter than ``n``)."""
    t = col(tokens)
    return F.when(F.size(t) >= n, F.transform(F.sequence(F.lit(0), F.size(t) - n),
                                              lambda i: F.array_join(F.slice(t, i + 1, n), " "))).otherwise(
        F.array().cast("array<string>"))


def ngram_range(tokens, lo: int, hi: int) -> Column:
    """T5: all n-grams for n in ``[lo, hi]`` (built on arrays before any explode)."""
    return F.flatten(F.array(*[ngrams(tokens, n) for n in range(lo, hi + 1)]))


def prefixed(tokens, prefix: str) -> Column:
    """Field-prefixed bag."""
    return F.transform(col(tokens), lambda t: F.concat(F.lit(prefix), t))
