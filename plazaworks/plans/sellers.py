"""Seller profiles and duplicate sellers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions.geo import geodesic_m, grid_cell, manhattan_km, parse_latlon
from ..functions.text import edit_distance, squeeze_blanks
from ..operators.entities import duplicates_wide
from ..operators.joins import attach
from ..operators.keys import latest_per_key
from ..operators.quality import compare_records
from ..operators.reshape import eav_pivot


def weekday_flags(text: str) -> dict[str, Column]:
    """0/1 per weekday named in a work-days text."""
    return {day: F.when(F.col(text).contains(mark), 1).otherwise(0) for day, mark in vocab.WEEKDAY_MARKS.items()}


def seller_profile(
    attributes: DataFrame, overrides: DataFrame, dropoffs: DataFrame, names: Sequence[str], sites: Mapping[str, tuple[float, float]] = {}
) -> DataFrame:
    """One row per seller from attribute rows, curated corrections and drop-off points.

    attributes: seller_id, name, value (attributes ``location``, ``work_days``,
    ``address``, ``phone``, ``district`` are used when listed in ``names``);
    overrides: seller_id, latitude, longitude, address, phone, district;
    dropoffs: seller_id, dropoff, dropoff_lon, dropoff_lat; sites: fixed points
    (lon, lat) whose distance is reported.
    """
    c = F.col
    wide = eav_pivot(attributes, ["seller_id"], "name", "value", names)
    lat, lon = parse_latlon("location")
    wide = wide.withColumns({"latitude": lat, "longitude": lon, "address": squeeze_blanks("address"), **weekday_flags("work_days")})
    over = overrides.select("seller_id", *[c(x).alias(f"o_{x}") for x in ("latitude", "longitude", "address", "phone", "district")])
    out = attach(attach(wide, over, ["seller_id"]), dropoffs, ["seller_id"])
    out = out.withColumns({"best_lon": F.coalesce("o_longitude", "longitude"), "best_lat": F.coalesce("o_latitude", "latitude")})
    moved = F.round(geodesic_m("longitude", "latitude", "o_longitude", "o_latitude"), 2)
    out = out.withColumns({"moved_m": F.coalesce(moved, F.lit(0.0)), "address_distance": edit_distance("address", "o_address")})
    out = compare_records(
        out,
        {
            "location_check": moved >= 25,
            "phone_check": c("phone") != c("o_phone"),
            "district_check": c("district") != c("o_district"),
            "address_check": c("address_distance") >= 5,
        },
    )
    cells = {f"cell_{r}": grid_cell("best_lon", "best_lat", r) for r in (8, 12)}
    far = {}
    for site, (x, y) in sites.items():
        far[f"geodesic_km_{site}"] = F.round(geodesic_m("best_lon", "best_lat", F.lit(x), F.lit(y)) / 1000, 2)
        far[f"manhattan_km_{site}"] = F.round(manhattan_km("best_lon", "best_lat", F.lit(x), F.lit(y)), 2)
    far["geodesic_km_dropoff"] = F.round(geodesic_m("best_lon", "best_lat", "dropoff_lon", "dropoff_lat") / 1000, 2)
    far["manhattan_km_dropoff"] = F.round(manhattan_km("best_lon", "best_lat", "dropoff_lon", "dropoff_lat"), 2)
    return out.withColumns({**cells, **far})


def duplicate_entities(df: DataFrame, entity: str, attrs: Sequence[str], order: Sequence[Column], k: int = 9) -> DataFrame:
    """Sellers with how many others share an attribute with them, and the first ``k`` of these."""
    one = latest_per_key(df, [entity], order)
    return attach(one, duplicates_wide(one, entity, attrs, k), [entity])
