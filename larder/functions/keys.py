"""Key expressions of star schemas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "0"


def surrogate_key(*parts: Column | str, sep: str = "-", skip_nulls: bool = False) -> Column:
    """md5 over the parts; the unknown member ``'0'`` if a part is missing.

    With ``skip_nulls`` missing parts are left out of the hashed text instead.
    """
    text = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    if skip_nulls:
        return F.md5(F.concat_ws(sep, *text))
    joined = text[0]
    for t in text[1:]:
        joined = F.concat(joined, F.lit(sep), t)
    return F.coalesce(F.md5(joined), F.lit(UNKNOWN))


def hashed_uniform(*parts: Column | str, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the key and a seed only, so reruns and row order do not matter."""
    cols = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    digest = F.md5(F.concat_ws("-", *cols, F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
