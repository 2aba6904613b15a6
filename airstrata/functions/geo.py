"""Coordinates and geometry text."""

from pyspark.sql import Column, functions as F


def lon_lat(lon: Column, lat: Column) -> Column:
    """Geo point of an index document: ``[longitude, latitude]``."""
    return F.array(lon, lat)


def lat_lon(lat: Column, lon: Column) -> Column:
    """Named pair used by the station table (the other order than ``lon_lat``)."""
    return F.struct(lat.alias("lat"), lon.alias("lon"))


def lat_lon_text(lat: Column, lon: Column) -> Column:
    """The pair as CSV text, ``(44.9, -0.5)``."""
    return F.concat(F.lit("("), lat.cast("string"), F.lit(", "), lon.cast("string"), F.lit(")"))


def number_text(number: Column) -> Column:
    """Plain decimal text without exponent and without trailing zeros."""
    size = F.abs(number)
    whole = (number == F.floor(number)) & (size < 1e15)
    exact = number.try_cast("decimal(38,17)").cast("string")
    return (
        F.when(whole, number.try_cast("bigint").cast("string"))
        .when((size >= 1e-3) & (size < 1e7), number.cast("string"))
        .otherwise(F.regexp_replace(exact, r"\.?0+$", ""))
    )


def _listed(texts: Column) -> Column:
    """The texts in brackets; NULL if one of them is NULL, so that no part is left out."""
    whole = ~F.exists(texts, lambda t: t.isNull())
    return F.when(whole, F.concat(F.lit("("), F.array_join(texts, ", "), F.lit(")")))


def _ring_text(ring: Column) -> Column:
    return _listed(
        F.transform(ring, lambda p: F.concat(number_text(p.x), F.lit(" "), number_text(p.y)))
    )


def _polygon_body(rings: Column) -> Column:
    return _listed(F.transform(rings, _ring_text))


def polygon_wkt(rings: Column) -> Column:
    """``array<array<struct<x,y>>>`` (outer ring, then holes) to WKT.

    NULL if any coordinate is NULL, or too large for 38 decimal digits.
    """
    return F.when(F.size(rings) == 0, F.lit("POLYGON EMPTY")).when(
        rings.isNotNull(), F.concat(F.lit("POLYGON "), _polygon_body(rings))
    )


def multipolygon_wkt(polygons: Column) -> Column:
    """Array of polygons (each an array of rings) to WKT; NULL as for ``polygon_wkt``."""
    texts = F.transform(polygons, _polygon_body)
    body = F.when(~F.exists(texts, lambda t: t.isNull()), F.array_join(texts, ", "))
    return F.when(F.size(polygons) == 0, F.lit("MULTIPOLYGON EMPTY")).when(
        polygons.isNotNull(), F.concat(F.lit("MULTIPOLYGON ("), body, F.lit(")"))
    )
