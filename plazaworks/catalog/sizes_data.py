"""Product measures made from the shared part table."""

from pyspark.sql import functions as F

from ..plans.sizes import assign_size
from ..session import cut_lineage

MEASURES = {
    "width": ("p_size*13%97", 10.0),
    "length": ("p_size*29%89", 10.0),
    "height": ("p_partkey*17%83", 100.0),
    "weight": ("p_partkey*31%1009", 8.0),
}


def raw_parts(t):
    """Parts with width, length, height, weight, a declared class and a category."""
    p = t("part", "p_partkey", "p_size", "p_brand", "p_type")
    cols = {n: F.expr(f"cast(({e}) as double)") / d for n, (e, d) in MEASURES.items()}
    sizes = F.array(*[F.lit(s) for s in ("S", "M", "L", "XL", "O", "EO")])
    return p.withColumns(cols).withColumns(
        {
            "size": F.get(sizes, (F.col("p_partkey") % 6).cast("int")),
            "category_code": F.when(F.col("p_type") == "PROMO", "G19080602").otherwise(F.concat(F.lit("G0"), F.substring("p_brand", 7, 2))),
            "dimension_quantity": F.col("p_size") * 2,
            "new_item_size": F.when(F.col("p_partkey") % 11 == 0, "XXL"),
        }
    )


def raw_sql():
    cols = ", ".join(f"CAST({e} AS DOUBLE)/{d}::DOUBLE AS {n}" for n, (e, d) in MEASURES.items())
    return (
        f"(SELECT p_partkey, p_size, p_brand, p_type, {cols}, list_extract(['S','M','L','XL','O','EO'],1+CAST(p_partkey%6 AS INT)) AS size, "
        "CASE WHEN p_type='PROMO' THEN 'G19080602' ELSE 'G0'||substr(p_brand,7,2) END AS category_code, p_size*2 AS dimension_quantity, "
        "CASE WHEN p_partkey%11=0 THEN 'XXL' END AS new_item_size FROM part)"
    )


def sized_parts(t):
    """Measures and final class, materialised because a model reads them many times."""
    rows = assign_size(raw_parts(t), corrected=None)
    return cut_lineage(rows.select("p_partkey", "width", "length", "height", "weight", "volume_m3", "size"))
