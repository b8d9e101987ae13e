"""Column expressions shared by the operators. All stay on the JVM side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from playtide.schema import MAX_SESSION_LENGTH, PAGE_VOCABULARY

# The names looked for in a user agent, first match wins.
BROWSER_PATTERN = "(Firefox|Chrome|Safari|Opera|Edge)"
OS_PATTERN = "(Windows|Macintosh|Android|iPhone|Linux)"


def epoch_ms_to_ts(ms: Column, truncate_seconds: bool = False) -> Column:
    """Epoch milliseconds to a timestamp, optionally cut to whole seconds."""
    if truncate_seconds:
        return F.timestamp_seconds(F.floor(ms / 1000))
    return F.timestamp_millis(ms)


def ratio(num: Column, den: Column, otherwise: Column | float = 0.0) -> Column:
    """A4: ``num / den`` where ``den`` is positive, else ``otherwise``."""
    fallback = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return F.when(den > 0, num / den).otherwise(fallback)


def page_count(*pages: str) -> Column:
    """Rows on one of ``pages``; never null, unlike a plain ``sum``."""
    names = ", ".join(f"'{page}'" for page in pages)
    return F.expr(f"count_if(page IN ({names}))")


def page_code(page: Column) -> Column:
    """Position of a page name in the vocabulary, 0 when it is unknown."""
    vocabulary = F.split(F.lit("|".join(PAGE_VOCABULARY)), "[|]")  # folded to a constant array
    return F.greatest(F.array_position(vocabulary, page) - 1, F.lit(0)).cast("int")


def scaled_sequence(codes: Column, max_len: int = MAX_SESSION_LENGTH) -> Column:
    """Pad or cut page codes to ``max_len`` and divide by vocabulary size."""
    padded = F.slice(F.concat(codes, F.array_repeat(F.lit(0), max_len)), 1, max_len)
    return F.transform(padded, lambda code: code / F.lit(float(len(PAGE_VOCABULARY))))


def risk_level(prob: Column, high: float = 0.7, medium: float = 0.4, inclusive: bool = False) -> Column:
    """Risk tier. ``inclusive`` puts a probability on the limit in the upper tier."""
    above = (lambda limit: prob >= limit) if inclusive else (lambda limit: prob > limit)
    return F.when(above(high), "high").when(above(medium), "medium").otherwise("low")


def hash_id(col: Column, buckets: int = 100_000) -> Column:
    """M1: index from the 32-bit hash; widened first since ANSI ``abs`` overflows."""
    return (F.abs(F.hash(col).cast("long")) % buckets).cast("int")


def stable_hash(seed: int | str, *cols: Column | str) -> Column:
    """60-bit non-negative hash of the text of ``cols``.

    It does not depend on partitioning or row order, so a retried task makes
    the same choice, and other engines can compute the same value.
    """
    parts = [F.lit(str(seed))] + [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cols
    ]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def stable_uniform(seed: int | str, *cols: Column | str) -> Column:
    """Stable number in [0, 1) for a row."""
    return stable_hash(seed, *cols) / F.lit(float(1 << 60))


def squared_norm(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v * v)


def minus(left: Column, right: Sequence[float]) -> Column:
    """Element-wise difference between an array column and a fixed vector."""
    fixed = F.expr(f"array({', '.join(f'{float(v)!r}D' for v in right)})")
    return F.zip_with(left, fixed, lambda a, b: a - b)
