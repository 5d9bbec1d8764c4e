"""Semi and anti join with a key list whose size is not known beforehand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgate.session import new_folder
from rowgate.spec import ref

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024


def listed_join(left: DataFrame, listed: DataFrame, keys: list[str], how: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows of ``left`` whose keys are (``left_semi``) or are not (``left_anti``) listed, safe when
    one key holds much of ``left``.

    The (distinct) list is written once and measured. Up to ``broadcast_rows`` keys (and
    ``BROADCAST_BYTES`` of text) are broadcast, so ``left`` does not move. A longer list is joined by
    sort-merge, never broadcast; adaptive execution splits a frequent key on the left side.
    """
    path = new_folder(left.sparkSession, "keys")
    listed.write.parquet(path)
    listed = left.sparkSession.read.schema(listed.schema).parquet(path)
    text = F.concat_ws("", *[ref(k).cast("string") for k in keys])
    size = listed.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("bytes")).first()
    small = size.n <= broadcast_rows and size.bytes <= BROADCAST_BYTES
    named = listed.select(*[ref(k).alias(f"listed {i}") for i, k in enumerate(keys)])
    same = [ref(k) == F.col(f"listed {i}") for i, k in enumerate(keys)]
    return left.join(F.broadcast(named) if small else named.hint("merge"), same, how)
