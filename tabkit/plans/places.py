"""Entity matching of two place lists: by distance, then by name for what is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.operators import geo, matching


def match_places(guide: DataFrame, site: DataFrame, limit: float, guide_id: str, site_id: str, countries: DataFrame | None = None, scale: float = 100.0, max_score: float | None = None) -> DataFrame:
    """(guide id, site id, how, score): near pairs first, then fuzzy names of guide rows without one.

    Both tables carry name, x and y (and country, when ``countries`` restricts them).
    """
    if countries is not None:
        guide = guide.join(countries.select("country"), "country", "left_semi")
    near = geo.near_pairs(guide, site, limit, guide_id, site_id, scale=scale)
    near = near.select(guide_id, site_id, F.lit("distance").alias("how"), F.col("d").alias("score"))
    rest = guide.join(near.select(guide_id).distinct(), guide_id, "left_anti")
    fuzzy = matching.join_fuzzily(site.select("name"), rest.select("name"), max_score=max_score, exact=True)
    by_name = (
        fuzzy.join(rest.select(guide_id, F.col("name").alias("name_y")), "name_y")
        .join(site.select(site_id, F.col("name").alias("name_x")), "name_x")
        .select(guide_id, site_id, F.lit("name").alias("how"), "score")
    )
    return near.unionByName(by_name)
