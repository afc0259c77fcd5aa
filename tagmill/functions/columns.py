"""Column helpers: identifiers, hashes, safe ratios, bounds and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def rounded(c: Column | str, digits: int = 6) -> Column:
    """Half-even rounding."""
    return F.bround(col(c), digits)


def precision(tp: Column, fp: Column) -> Column:
    return ratio(tp, tp + fp)


def recall(tp: Column, fn: Column) -> Column:
    return ratio(tp, tp + fn)


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    p, r = precision(tp, fp), recall(tp, fn)
    return ratio(2 * p * r, p + r)


def wilson_lower(k: Column, n: Column, z: float = 1.96) -> Column:
    """Lower end of the Wilson interval of k successes in n; 0 where n is 0."""
    n = F.nullif(n, F.lit(0))
    p = k.cast("double") / n
    centre = p + z * z / (2 * n)
    spread = z * F.sqrt((p * (1 - p) + z * z / (4 * n)) / n)
    return F.coalesce(F.when((lower := (centre - spread) / (1 + z * z / n)) > 0, lower), F.lit(0.0))


def tradition_of(chunk_id: Column | str) -> Column:
    return F.split_part(col(chunk_id), F.lit("."), F.lit(1))


def text_of(chunk_id: Column | str) -> Column:
    """tradition.text of an id of three parts; the whole id if it has fewer."""
    parts = F.split(col(chunk_id), r"\.", 3)
    return F.when(F.size(parts) < 3, col(chunk_id)).otherwise(F.concat_ws(".", parts[0], parts[1]))


def work_of(chunk_id: Column | str) -> Column:
    """The id without its last dotted part."""
    return F.regexp_replace(col(chunk_id), r"\.[^.]*$", "")


def pair_key(a: Column | str, b: Column | str, sep: str = "|") -> Column:
    """One key for both orders of a pair."""
    return F.concat(F.least(col(a), col(b)), F.lit(sep), F.greatest(col(a), col(b)))


def shuffle_key(seed: str, *keys: Column | str) -> Column:
    """A deterministic random order: the hash of seed and keys, the same in any engine."""
    return F.sha2(F.concat_ws(":", F.lit(seed), *[col(k).cast("string") for k in keys]), 256)


def bucket(seed: str, key: Column | str) -> Column:
    """A number in [0, 1) from the first 8 bytes of the hash of `seed:key`."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), col(key)), 256)
    return F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(float(2**64))


def split_name(seed: str, key: Column | str, val: float = 0.05, test: float = 0.05) -> Column:
    b = bucket(seed, key)
    return F.when(b < val, "val").when(b < val + test, "test").otherwise("train")


def query_hash(query: Column | str) -> Column:
    return F.substring(F.sha2(col(query), 256), 1, 16)


def dot(a: Column | str, b: Column | str) -> Column:
    """Scalar product of two arrays of doubles."""
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column | str) -> Column:
    return F.sqrt(F.aggregate(col(v), F.lit(0.0), lambda s, x: s + x * x))


def unit(v: Column | str) -> Column:
    """v over its length; a zero vector stays."""
    n = norm(v)
    return F.when(n > 0, F.transform(col(v), lambda x: x / n)).otherwise(col(v))


def percent(part: Column | str, whole: Column | str, digits: int = 1) -> Column:
    """A share as text, such as " 12.5%"; dashes where the whole is 0 or null."""
    share = F.try_divide(col(part).cast("double") * 100, col(whole).cast("double"))
    shown = F.when(share.isNotNull(), F.format_string(f"%{digits + 4}.{digits}f%%", share))
    return F.coalesce(shown, F.lit("--".center(digits + 5)))


def signed(value: Column | str, digits: int = 3) -> Column:
    """A number with its sign as text; null stays."""
    return F.when(col(value).isNotNull(), F.format_string(f"%+.{digits}f", col(value).cast("double")))
