"""Entities that share an attribute value (duplicate detection).

Listing every pair of a shared value grows with the square of the group, and
one phone number may be shared by a third of all entities.  The reports only
use two things of the pairs: how many distinct partners an entity has, and the
first few of them.  Both are computed here exactly without making any pair.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import attach
from .keys import top_per_key


def shared_groups(df: DataFrame, entity: str, attrs: Sequence[str]) -> DataFrame:
    """(entity, attribute, value, size, first member): the shared values in linear size."""
    parts = None
    for a in attrs:
        members = df.where(F.col(a).isNotNull()).select(entity, F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value")).distinct()
        parts = members if parts is None else parts.unionByName(members)
    groups = parts.groupBy("attribute", "value").agg(F.count(F.lit(1)).alias("group_size"), F.min(entity).alias("first_member"))
    return attach(parts, groups.where(F.col("group_size") > 1), ["attribute", "value"]).where(F.col("group_size").isNotNull())


def union_sizes(df: DataFrame, attrs: Sequence[str], name: str) -> DataFrame:
    """``df`` with the number of rows that share the value of at least one attribute, the row itself included.

    Rows with the same values are one signature with a count.  Each signature
    lists the combinations of its known attributes; the sizes of all of them come
    from one aggregate and go back in one join, whatever the number of attributes,
    and add up by inclusion and exclusion.  Combinations and signatures are told
    apart by 128 bits.
    """
    texts = [F.col(a).cast("string") for a in attrs]
    same = {f"_s{half}": F.xxhash64(F.lit(half), F.concat(*[F.isnull(x).cast("string") for x in texts]), *texts) for half in (0, 1)}
    marked = df.withColumns(same)
    sigs = marked.groupBy(*same).agg(F.count(F.lit(1)).alias("_m"), *[F.first(x).alias(f"_a{i}") for i, x in enumerate(texts)])
    cells = []
    for bits in range(1, 1 << len(attrs)):
        chosen = [F.col(f"_a{i}") for i in range(len(attrs)) if bits >> i & 1]
        known = reduce(lambda a, b: a & b, [x.isNotNull() for x in chosen])
        keys = [F.when(known, F.xxhash64(F.lit(2 * bits + half), *chosen)).alias(f"_k{half}") for half in (0, 1)]
        cells.append(F.struct(F.lit(1 if len(chosen) % 2 else -1).alias("_sign"), *keys))
    spread = sigs.select(*same, "_m", F.explode(F.array(*cells)).alias("_c")).select(*same, "_m", "_c.*").where(F.col("_k0").isNotNull())
    sizes = spread.groupBy("_k0", "_k1").agg(F.sum("_m").alias("_size"))
    total = spread.join(sizes, ["_k0", "_k1"]).groupBy(*same).agg(F.sum(F.col("_sign") * F.col("_size")).alias(name))
    return marked.join(total, list(same), "left").drop(*same).withColumn(name, F.coalesce(name, F.lit(0)))


def duplicates_wide(df: DataFrame, entity: str, attrs: Sequence[str], k: int = 9, name: str = "dup") -> DataFrame:
    """Number of distinct partners over all attributes and the ``k`` largest partner ids.

    ``df`` has one row per entity.  The partner count is the size of a union of
    groups (:func:`union_sizes`); the partner ids come from the ``k + 1`` largest ids of each shared
    value, which always contain the ``k`` largest of the union.
    """
    base, lists = df.select(entity, *attrs), []
    out = union_sizes(base, attrs, "_union")
    for a in attrs:
        top = top_per_key(base.where(F.col(a).isNotNull()).select(a, entity), [a], [F.desc(entity)], k + 1, "_r")
        out = attach(out, top.groupBy(a).agg(F.collect_list(entity).alias(f"_l_{a}")), [a])
        lists.append(F.coalesce(F.col(f"_l_{a}"), F.array().cast(f"array<{dict(df.dtypes)[entity]}>")))
    partners = F.sort_array(F.array_except(F.array_distinct(F.concat(*lists)), F.array(F.col(entity))), asc=False)
    return out.select(
        entity,
        F.greatest(F.col("_union") - 1, F.lit(0)).cast("bigint").alias(f"n_{name}"),
        *[F.get(partners, F.lit(i)).alias(f"{name}{i + 1}") for i in range(k)],
    )
