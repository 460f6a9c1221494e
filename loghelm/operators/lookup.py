"""Left lookup of a keyed table, with a size check and hot keys split up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loghelm.session import materialize

BROADCAST_BYTES = 64 << 20
ROWS_PER_SALT = 1_000_000


def table_bytes(df: DataFrame) -> int:
    """Approximate size of a materialized table: widths of its columns summed."""

    def width(field: T.StructField) -> Column:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            return F.octet_length(col)
        if isinstance(field.dataType, T.ArrayType):
            return F.size(col) * (40 if isinstance(field.dataType.elementType, T.StringType) else 8)
        return F.lit(8)

    widths = [F.coalesce(width(f), F.lit(0)).cast("long") + 16 for f in df.schema.fields]
    total = widths[0]
    for w in widths[1:]:
        total = total + w
    return df.agg(F.sum(total)).first()[0] or 0


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only for a materialized table measured below the limit."""
    return F.broadcast(df) if table_bytes(df) <= limit else df


def sampled_counts(facts: DataFrame, key: str, fraction: float = 0.01) -> DataFrame:
    """Estimated row counts `n` of the keys, from a row sample. They only steer
    how rows are spread over tasks; the join result is the same whatever they are."""
    sample = facts.select(key).where(F.col(key).isNotNull()).sample(fraction, seed=7)
    return sample.groupBy(key).agg((F.count("*") / fraction).cast("long").alias("n"))


def lookup(
    facts: DataFrame,
    table: DataFrame,
    key: str,
    spread: tuple[str, ...],
    counts: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """`facts` left-joined with `table` (unique in `key`, materialized).

    A table measured as small is broadcast and `facts` do not move. Otherwise
    the rows of a hot key, one of more than `rows_per_salt` rows by `counts`
    (key, `n`; a sample where not given), are spread by a hash of the `spread`
    columns over as many sub-keys as its row count needs, and its table row is
    repeated for each; rows without a key, which match nothing, are spread freely.
    Hot keys are marked by their hash, about 32 bytes per `rows_per_salt` rows of
    `facts`; the mark table is broadcast after its size was checked.
    """
    if table_bytes(table) <= broadcast_bytes:
        return facts.join(F.broadcast(table), key, "left")
    counts = sampled_counts(facts, key) if counts is None else counts
    salts = F.ceil(F.max("n") / rows_per_salt).cast("int").alias("__salts")
    mark = F.xxhash64(key)
    hot = counts.where(F.col("n") > rows_per_salt).groupBy(mark.alias("__mark")).agg(salts)
    marks = broadcast_if_small(materialize(hot))
    spread_over = F.when(F.col(key).isNull(), F.lit(1 << 30)).otherwise(F.coalesce("__salts", F.lit(1)))
    salted_facts = facts.withColumn("__mark", mark).join(marks, "__mark", "left").withColumn(
        "__salt", F.pmod(F.xxhash64(*spread), spread_over).cast("int")
    )
    copies = F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1)
    salted_table = table.withColumn("__mark", mark).join(marks, "__mark", "left").withColumn("__salt", F.explode(copies))
    inner = ("__salts", "__mark")
    joined = salted_facts.drop(*inner).join(salted_table.drop(*inner), [key, "__salt"], "left")
    return joined.drop("__salt")
