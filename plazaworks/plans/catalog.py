"""Products, prices, reviews, nodes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import jsonx, text
from ..functions.dates import as_date
from ..functions.numbers import decimal_comma
from ..functions.sem import regexp_extract_n, safe_cast
from ..operators.joins import attach
from ..operators.keys import latest_per_key
from ..operators.rules import case_first

LEVELS = (("g1", 3), ("g2", 5), ("g3", 7), ("g4", 9))


def category_levels(code: str) -> dict[str, Column]:
    """Prefix of a category code per level; short codes repeat their longest prefix."""
    c = F.col(code)
    out, shorter = {}, c
    for name, n in LEVELS:
        shorter = F.when(F.length(c) >= n, F.substring(c, 1, n)).otherwise(shorter)
        out[name] = shorter
    return out


def effective_price(prices: DataFrame, as_of: str) -> DataFrame:
    """Price in force per sku: running event, else internet price, else normal price.

    prices: sku, price_normal, price_internet, price_event, event_end.
    """
    zero = lambda n: F.coalesce(F.col(n), F.lit(0))
    newest = latest_per_key(prices, ["sku"], [F.desc("event_end"), F.desc("price_event"), F.desc("price_internet"), F.desc("price_normal")])
    price = case_first(
        [(F.col("event_end") >= as_date(as_of), zero("price_event")), (zero("price_internet") > 0, zero("price_internet"))], zero("price_normal")
    )
    return newest.withColumn("price", price)


def product_dimensions(products: DataFrame, attributes: str = "attributes") -> DataFrame:
    """Measures, screen size, model, pieces, packs, condition and warranty from the attribute document.

    The document is parsed once into a map; every preferred key list is then a
    lookup in that map.
    """
    df = products.withColumn("_m", jsonx.as_map(attributes))
    number = lambda keys: decimal_comma(jsonx.first_of_keys("_m", keys))
    said = lambda keys: jsonx.first_of_keys("_m", keys)
    model = F.upper(F.regexp_replace(text.fold_accents(jsonx.first_of_keys("_m", [vocab.MODEL_KEY])), "[^a-zA-Z0-9._ ]", ""))
    screen = safe_cast(jsonx.first_of_keys("_m", vocab.SCREEN_KEYS), "double")
    return df.withColumns(
        {
            "width": number(vocab.WIDTH_KEYS),
            "length": number(vocab.LENGTH_KEYS),
            "height": number(vocab.HEIGHT_KEYS),
            "weight": number(vocab.WEIGHT_KEYS),
            "pieces": number(vocab.PIECES_KEYS),
            "packs": number(vocab.PACKS_KEYS),
            "condition_id": said(vocab.CONDITION_KEYS),
            "condition_detail": said(vocab.CONDITION_DETAIL_KEYS),
            "seller_warranty": F.lower(said(vocab.SELLER_WARRANTY_KEYS)),
            "warranty_terms": F.lower(said(vocab.WARRANTY_TERMS_KEYS)),
            "supplier_warranty_id": said(vocab.SUPPLIER_WARRANTY_KEYS),
            "screen": F.when(screen < 99, screen),
            "model": F.regexp_replace(model, "_DELETED.*$", ""),
        }
    ).drop("_m")


def product_variation(products: DataFrame, variation: str = "variation") -> DataFrame:
    """Colours and apparel size from the variation document, parsed once."""
    df = products.withColumn("_m", jsonx.as_map(variation))
    said = lambda keys: jsonx.first_of_keys("_m", keys)
    return df.withColumns(
        {
            "colour": said(vocab.COLOUR_KEYS),
            "basic_colour": said(vocab.BASIC_COLOUR_KEYS),
            "second_colour": said(vocab.SECOND_COLOUR_KEYS),
            "apparel_size": said(vocab.APPAREL_SIZE_KEYS),
        }
    ).drop("_m")


def product_names(products: DataFrame, name: str = "name", category: str = "category", code: str = "category_code") -> DataFrame:
    """Clean name and the amount and unit it states."""
    levels = products.withColumns(category_levels(code))
    clean = text.contextual_name(text.normalise_units(name), F.lower(text.fold_accents(category)), F.col("g1"))
    named = levels.withColumn("product_name", clean)
    unit = F.when(F.col(code).isin(*vocab.SCREEN_CATEGORY_IDS), "in").otherwise(text.dimension_unit("product_name"))
    return named.withColumns({"name_quantity": text.dimension_quantity("product_name"), "dimension_units": unit})


def level_names(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Category names of all four levels; categories: g1..g4, n1..n4."""
    out = products
    for i, (g, _) in enumerate(LEVELS, 1):
        names = categories.where(F.col(g).isNotNull()).groupBy(g).agg(text.fold_accents(F.max(f"n{i}")).alias(f"n{i}"))
        out = attach(out, names, [g])
    return out


def logistics_sizes(logistics: DataFrame) -> DataFrame:
    """Measured size per sku from the nested logistics catalogue.

    Every offering of an item has every footprint of it; items without either
    are left out.  One row per sku: the largest of each measure.
    """
    rows = logistics.select(F.explode("item_info.offering_id").alias("sku"), "presentation_footprints")
    rows = rows.select("sku", F.inline("presentation_footprints"))
    return rows.groupBy("sku").agg(
        F.max("item_size").alias("size"),
        *[F.max(c).alias(c) for c in ("length_in_cm", "width_in_cm", "height_in_cm", "weight_in_kg")],
    )


def size_histogram(products: DataFrame, category: str, size: str, sku: str, sizes: Sequence[str] = vocab.SIZES) -> DataFrame:
    """Distinct skus of each size class per category."""
    return products.groupBy(category).agg(
        *[F.count_distinct(F.when(F.col(size) == s, F.col(sku))).alias(f"dist_{s.lower()}") for s in sizes]
    )


def sku_master(products: DataFrame, data: DataFrame, logistics: DataFrame, prices: DataFrame, categories: DataFrame, as_of: str, options: DataFrame | None = None) -> DataFrame:
    """Product master: names, levels, attributes, variation, measured size, price, size histogram.

    products: sku, seller_id, name, category, category_code, product_set,
    variation; data: product_set, attributes; of several documents of a set the
    smallest text counts.  options (option_id, option_name) names the condition
    and the supplier's warranty.
    """
    rows = attach(products, data.groupBy("product_set").agg(F.min("attributes").alias("attributes")), ["product_set"])
    rows = level_names(product_names(product_variation(product_dimensions(rows))), categories)
    if options is not None:
        named = options.groupBy("option_id").agg(F.max("option_name").alias("option_name"))
        for c in ("condition", "supplier_warranty"):
            rows = attach(rows, named.select(F.col("option_id").alias(f"{c}_id"), F.lower("option_name").alias(c)), [f"{c}_id"])
    rows = attach(rows, logistics_sizes(logistics), ["sku"])
    rows = attach(rows, effective_price(prices, as_of).select("sku", "price"), ["sku"])
    rows = rows.withColumn("dimension_quantity", F.coalesce("screen", "name_quantity")).drop("attributes", "variation", "name_quantity")
    return attach(rows, size_histogram(rows, "category_code", "size", "sku"), ["category_code"])


def review_report(reviews: DataFrame, products: DataFrame, catalog: DataFrame) -> DataFrame:
    """Newest version of each review with the sku and seller it is about.

    reviews: review_id, product_id, processed_at, rating, title, review;
    products: sku, product_id; catalog: sku, seller_id.
    """
    newest = latest_per_key(reviews, ["review_id"], [F.desc("processed_at"), F.desc("rating"), F.desc("title")])
    clean = newest.withColumns(
        {
            "title": F.lower(text.fold_accents("title")),
            "review": F.lower(text.fold_accents(F.regexp_replace("review", ",", ""))),
        }
    )
    sold = products.select("product_id", "sku").distinct().join(catalog.select("sku", "seller_id").distinct(), "sku")
    return clean.join(sold, "product_id").distinct()


def parse_nodes(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """Newest node per seller and delivery type, read from the node's name.

    links: process, node_id; nodes: node_id, node_name, changed_at.
    """
    n = F.col("node_name")
    pieces = {k: regexp_extract_n(n, p) for k, p in vocab.NODE_NAME.items()}
    pieces["frequency"] = F.trim(F.replace(pieces["frequency"], F.lit(")"), F.lit("")))
    kinds = [(F.col("delivery_method").isin(*w), k) for k, w in vocab.NODE_DELIVERY_TYPE.items()]
    parsed = nodes.withColumns(pieces).withColumn("delivery_type", case_first(kinds))
    rows = links.select(regexp_extract_n("process", vocab.NODE_SELLER).alias("seller_id"), "node_id").where(F.col("seller_id").isNotNull())
    rows = rows.join(parsed.where(F.col("delivery_type").isNotNull()), "node_id")
    return latest_per_key(rows, ["seller_id", "delivery_type"], [F.desc("changed_at"), F.desc("node_id")])
