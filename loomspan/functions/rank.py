"""Places in an order over the whole table, without a task that holds it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import stored


def numbered(df: DataFrame, order: list[str], by: list[str] | None = None, name: str = "place") -> DataFrame:
    """df with the 1-based place of each row in `order`, within each value of `by`.

    Rows are dealt by ranges of (by, order) and numbered within their range; what
    one task then adds up is a row for each range and value of `by`.
    """
    by = by or []
    keys = [*by, *order]
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_range", F.spark_partition_id())
    dealt = stored(dealt, "ranges")
    part = ", ".join(f"`{c}`" for c in ["_range", *by])
    local = dealt.withColumn("_local", F.expr(f"row_number() OVER (PARTITION BY {part} ORDER BY {', '.join(f'`{c}`' for c in order)})"))
    sizes = dealt.groupBy("_range", *by).agg(F.count("*").alias("_n"))
    over = f"PARTITION BY {', '.join(f'`{c}`' for c in by)} " if by else ""
    before = sizes.select("_range", *by, F.expr(f"coalesce(sum(_n) OVER ({over}ORDER BY _range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("_before"))
    renamed = before.select(F.col("_range").alias("_r"), *[F.col(c).alias(f"_b_{c}") for c in by], "_before")
    same = F.col("_range") == F.col("_r")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    return local.join(renamed, same).select(*df.columns, (F.col("_before") + F.col("_local")).alias(name))
