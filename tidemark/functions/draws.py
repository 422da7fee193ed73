"""Hash-derived draws: the same result on every partitioning, and the same in any SQL engine with md5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.columns import ColumnLike, col


def draw(seed: int, rep: ColumnLike, i: ColumnLike, n: ColumnLike) -> Column:
    """Integer in ``[0, n)`` for replicate ``rep`` and draw number ``i``."""
    text = F.concat_ws("|", F.lit(str(seed)), col(rep).cast("string"), col(i).cast("string"))
    # sixty bits: far more than there are positions
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint") % col(n)
