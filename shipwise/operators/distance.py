"""Seller-customer distance (X1): centroids of postcode prefixes, haversine, mean per order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
# A bounding box of Brazil (least and greatest latitude and longitude).
BRAZIL = (-33.75, 5.28, -73.99, -34.79)


def centroids(geolocation: DataFrame, box: tuple[float, float, float, float] = BRAZIL) -> DataFrame:
    """(prefix, lat, lng): mean place of each prefix over the points inside ``box``."""
    south, north, west, east = box
    inside = F.col("geolocation_lat").between(south, north) & F.col("geolocation_lng").between(west, east)
    return (
        geolocation.where(inside & F.col("geolocation_zip_code_prefix").isNotNull())
        .groupBy(F.col("geolocation_zip_code_prefix").alias("prefix"))
        .agg(F.avg("geolocation_lat").alias("lat"), F.avg("geolocation_lng").alias("lng"))
    )


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2), F.lit(2.0))
    chord = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lng1, lng2)
    # rounding may pass 1; least() would turn an unknown place into the far side of the earth
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.when(chord > 1, F.lit(1.0)).otherwise(F.sqrt(chord)))


def seller_customer_distance(
    orders: DataFrame, order_items: DataFrame, customers: DataFrame, sellers: DataFrame, geolocation: DataFrame,
    box: tuple[float, float, float, float] = BRAZIL,
) -> DataFrame:
    """(order_id, seller_customer_km): mean over the order's sellers; null where no pair of places is known.

    Prefixes resolve on the narrow customer and seller tables, so the large
    tables join by id only. Items are cut to distinct (order, seller) pairs
    before any join, combined on the map side.
    """
    places = centroids(geolocation, box)

    def placed(people: DataFrame, kind: str) -> DataFrame:
        return people.select(f"{kind}_id", F.col(f"{kind}_zip_code_prefix").alias("prefix")).join(places, "prefix", "left").select(
            f"{kind}_id", F.col("lat").alias(f"{kind}_lat"), F.col("lng").alias(f"{kind}_lng")
        )

    pairs = order_items.select("order_id", "seller_id").distinct().join(placed(sellers, "seller"), "seller_id", "left")
    buyers = orders.select("order_id", "customer_id").join(placed(customers, "customer"), "customer_id", "left").drop("customer_id")
    km = haversine_km(F.col("customer_lat"), F.col("customer_lng"), F.col("seller_lat"), F.col("seller_lng"))
    return buyers.join(pairs, "order_id", "left").groupBy("order_id").agg(F.avg(km).alias("seller_customer_km"))
