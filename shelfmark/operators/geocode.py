"""Coordinates from tables of saved responses; nearest address of a point."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfmark.functions.text import blank_to_null, strip
from shelfmark.session import pinned

RESPONSE = (
    "features array<struct<"
    "geometry:struct<coordinates:array<double>>,"
    "properties:struct<label:string,score:double,city:string,postcode:string,"
    "context:string,type:string>>>"
)
NOT_FOUND = "not_found"


def requests_for(
    shops: DataFrame, key: str = "row_number", address: str = "adresse", city: str = "ville",
    postcode: str = "code_postal",
) -> DataFrame:
    """(id, address, city, postcode) of the shops to look up."""
    return shops.select(
        F.col(key).alias("id"),
        F.coalesce(F.col(address), F.lit("")).alias("address"),
        F.coalesce(F.col(city), F.lit("")).alias("city"),
        F.coalesce(F.col(postcode), F.lit("")).alias("postcode"),
    )


def lookup_key(address: Column, city: Column, postcode: Column) -> Column:
    """Lower-cased, stripped parts joined by ``|``; absent parts are left out."""
    return F.concat_ws(
        "|",
        F.coalesce(strip(F.lower(address)), F.lit("")),
        strip(F.lower(blank_to_null(city))),
        strip(blank_to_null(postcode)),
    )


def query_text(address: Column, city: Column, postcode: Column) -> Column:
    return F.concat_ws(" ", address, blank_to_null(city), blank_to_null(postcode))


def query_url(endpoint: str, address: Column, city: Column, postcode: Column, limit: int = 1) -> Column:
    """Request address: percent-encoded text (``/`` stays), limit, postcode filter."""
    encoded = F.replace(F.url_encode(query_text(address, city, postcode)), F.lit("+"), F.lit("%20"))
    encoded = F.replace(F.replace(encoded, F.lit("%2F"), F.lit("/")), F.lit("%7E"), F.lit("~"))
    encoded = F.replace(encoded, F.lit("*"), F.lit("%2A"))
    url = F.concat(F.lit(f"{endpoint}?q="), encoded, F.lit(f"&limit={limit}"))
    given = blank_to_null(postcode)
    return F.concat(url, F.coalesce(F.concat(F.lit("&postcode="), given), F.lit("")))


def distinct_lookups(requests: DataFrame) -> DataFrame:
    """Each normalised key once, with one query text; copies combine map-side."""
    parts = [F.col(c) for c in ("address", "city", "postcode")]
    return (
        requests.groupBy(lookup_key(*parts).alias("key"))
        .agg(F.min(query_text(*parts)).alias("query"))
    )


def parse_responses(responses: DataFrame, body: str = "body") -> DataFrame:
    """(key, latitude, longitude, label, ...) of saved JSON bodies.

    Coordinates come as [longitude, latitude]. A broken body, no feature or a
    short coordinate list gives NULL coordinates: the negative answer is kept.
    """
    parsed = F.from_json(F.col(body), RESPONSE)
    feature = F.get(parsed["features"], F.lit(0))
    coords = feature["geometry"]["coordinates"]
    found = F.size(coords) >= 2
    props = feature["properties"]

    def prop(name: str, default: object) -> Column:
        return F.when(found, F.coalesce(props[name], F.lit(default))).alias(name)

    return responses.select(
        "key",
        F.when(found, F.get(coords, F.lit(1))).alias("latitude"),
        F.when(found, F.get(coords, F.lit(0))).alias("longitude"),
        prop("label", ""),
        prop("score", 0.0),
        prop("city", ""),
        prop("postcode", ""),
        prop("context", ""),
        prop("type", ""),
        F.when(
            found, F.get(F.from_json(F.get_json_object(body, "$.features"), "array<string>"), F.lit(0))
        ).alias("raw_response"),
    )


def one_answer_per_key(answers: DataFrame) -> DataFrame:
    """The best answer of each key: one with coordinates, then the latest, then the highest score.

    Answers are dated where they have ``queried_at``; ties go by the remaining
    columns, so the choice is the same in every run.
    """
    rest = [c for c in answers.columns if c != "key"]
    found = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    ranked = [c for c in ("queried_at", "score", "latitude", "longitude", "label", "raw_response") if c in rest]
    best = F.max_by(F.struct(*rest), F.struct(found.alias("found"), *ranked)).alias("_best")
    return answers.groupBy("key").agg(best).select("key", *[F.col("_best")[c].alias(c) for c in rest])


def geocode(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """One result per request, misses with NULL coordinates and an error.

    Of several answers to one key only the best counts, so the join never
    multiplies rows; a key shared by very many requests is split by AQE on the
    request side.
    """
    key = lookup_key(F.col("address"), F.col("city"), F.col("postcode"))
    asked = requests.select(
        F.col("id").alias("original_id"), "address", key.alias("key")
    )
    out = asked.join(one_answer_per_key(answers.drop("address")), "key", "left")
    missing = F.col("latitude").isNull() | F.col("longitude").isNull()
    return out.withColumn("error", F.when(missing, F.lit(NOT_FOUND)))


def enrich(shops: DataFrame, results: DataFrame, key: str = "row_number") -> DataFrame:
    """Put the found coordinates on the shops; latitude 0.0 is a real coordinate."""
    coords = results.filter("latitude is not null").select(
        F.col("original_id").alias(key),
        F.col("latitude").alias("_lat"),
        F.col("longitude").alias("_lon"),
    )
    joined = shops.join(coords, key, "left")
    for column, new in (("latitude", "_lat"), ("longitude", "_lon")):
        if column in shops.columns:
            joined = joined.withColumn(column, F.coalesce(F.col(new), F.col(column)))
        else:
            joined = joined.withColumn(column, F.col(new))
    return joined.drop("_lat", "_lon")


def found_only(results: DataFrame, *, source: str, batch_id: str) -> DataFrame:
    """Bronze geocoding rows: successful responses, stamped."""
    fields = (
        "original_id", "latitude", "longitude", "label", "score", "city", "postcode",
        "context", "type", "raw_response",
    )
    return results.filter("latitude is not null").select(
        F.struct(*fields).alias("result"),
        F.struct(
            F.lit(source).alias("source"),
            F.current_timestamp().alias("queried_at"),
            F.lit(batch_id).alias("batch_id"),
        ).alias("_metadata"),
    )


def geocode_stats(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """One row: look-ups made, cache hits, keys found, keys not found, requests in error.

    A key without any stored answer stands for a failed call, which is not
    remembered: every such request is an error.
    """
    parts = [F.col(c) for c in ("address", "city", "postcode")]
    keys = requests.groupBy(lookup_key(*parts).alias("key")).agg(F.count("*").alias("n"))
    known = answers.select("key", F.col("latitude").isNotNull().alias("hit"))
    joined = keys.join(known, "key", "left")
    answered = F.col("hit").isNotNull()

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    return joined.agg(
        F.count_if(answered).alias("requests_made"),
        total(F.when(answered, F.col("n") - 1)).alias("cache_hits"),
        F.count_if(F.col("hit")).alias("successful"),
        F.count_if(~F.col("hit")).alias("not_found"),
        total(F.when(~answered, F.col("n"))).alias("errors"),
    )


# ------------------------------------------------------- nearest address

# Cell edges in degrees, coarse to fine; each level splits a cell into 8 x 8.
_LEVELS = (32.0, 4.0, 0.5, 0.0625, 0.0078125)
EARTH_KM = 6371.0088
# levels whose cells are few on any globe
_BROADCAST_LEVELS = 3


def _cell(lat: Column, lon: Column, size: float) -> Column:
    rows = F.floor((lat + 90.0) / size).cast("bigint")
    cols = F.floor((lon + 180.0) / size).cast("bigint")
    return rows * F.lit(1 << 32) + cols


def _haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine of the central angle: grows with distance, needs no root."""
    dlat = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
    dlon = F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * dlon


def _gap(value: Column, low: Column, high: Column) -> Column:
    return F.greatest(low - value, value - high, F.lit(0.0))


def _lower_bound(lat: Column, lon: Column, box: Column) -> Column:
    """No address inside ``box`` has a smaller haversine than this."""
    dlat = _gap(lat, box["lat_min"], box["lat_max"])
    direct = _gap(lon, box["lon_min"], box["lon_max"])
    around = F.least(
        _gap(lon + 360.0, box["lon_min"], box["lon_max"]),
        _gap(lon - 360.0, box["lon_min"], box["lon_max"]),
    )
    dlon = F.least(direct, around)
    narrowest = F.least(F.cos(F.radians(box["lat_min"])), F.cos(F.radians(box["lat_max"])))
    return F.pow(F.sin(F.radians(dlat) / 2), 2) + F.cos(F.radians(lat)) * narrowest * F.pow(
        F.sin(F.radians(dlon) / 2), 2
    )


def nearest_address(points: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Nearest gazetteer row of every point, exact at any distance.

    ``points`` (point_id, latitude, longitude); ``gazetteer`` (address_id,
    latitude, longitude, ...). Returns point_id, address_id, distance_km; equal
    distances go to the smallest address_id.

    Points and addresses are first reduced to distinct coordinates. Points then
    walk down a grid of cells: at each level a point keeps the cells whose
    bounding box could beat the closest representative seen so far. A step is
    an equi join on the cell (at most 64 children each), never a product, and
    the pruning is exact because the box bound is never above a true distance.

    The grid bounds the cells of the first three levels (259,200 of half a
    degree), whatever the tables hold: they are broadcast, so a point stays in
    one task until then. Further down it leaves out, before any exchange, the
    cells that the closest representative of the levels above rules out.
    """
    spots = (
        gazetteer.dropna(subset=["latitude", "longitude"])
        .select(
            "address_id",
            F.col("latitude").cast("double").alias("lat"),
            F.col("longitude").cast("double").alias("lon"),
        )
        .groupBy("lat", "lon")
        .agg(F.min("address_id").alias("address_id"))
    )
    levels = [_cell(F.col("lat"), F.col("lon"), s).alias(f"c{i}") for i, s in enumerate(_LEVELS)]
    spots = pinned(spots.select("*", *levels))

    places = points.dropna(subset=["latitude", "longitude"]).select(
        "point_id",
        F.col("latitude").cast("double").alias("plat"),
        F.col("longitude").cast("double").alias("plon"),
    )
    here = places.select("plat", "plon").distinct()

    def boxes(level: int) -> DataFrame:
        parent = F.col(f"c{level - 1}") if level else F.lit(0).cast("bigint")
        # any member serves as representative: it only has to be a real address
        cells = spots.groupBy(parent.alias("parent"), F.col(f"c{level}").alias("cell")).agg(
            F.struct(
                F.min("lat").alias("lat_min"),
                F.max("lat").alias("lat_max"),
                F.min("lon").alias("lon_min"),
                F.max("lon").alias("lon_max"),
            ).alias("box"),
            F.min(F.struct("lat", "lon")).alias("rep"),
        )
        return F.broadcast(cells) if level < _BROADCAST_LEVELS else cells

    plat, plon = F.col("plat"), F.col("plon")
    # a hair of slack keeps rounding from cutting off the true cell
    slack = F.lit(1e-15)
    # NaN is above every number, and equal to itself; this window deals the points out once for those below,
    # which else would exchange each point with all cells of the first level
    none_yet = F.min(F.lit(float("nan"))).over(W.partitionBy("plat", "plon"))
    front = here.select("plat", "plon", F.lit(0).cast("bigint").alias("parent"), none_yet.alias("best"))
    for level in range(len(_LEVELS)):
        options = front.join(boxes(level), "parent").select(
            "plat",
            "plon",
            "cell",
            "best",
            _lower_bound(plat, plon, F.col("box")).alias("low"),
            _haversine(plat, plon, F.col("rep.lat"), F.col("rep.lon")).alias("high"),
        ).filter(F.col("low") <= F.col("best") + slack)
        # a point meets a bounded number of cells, so its window stays small
        best = F.least("best", F.min("high").over(W.partitionBy("plat", "plon")))
        front = (
            options.withColumn("best", best)
            .filter(F.col("low") <= F.col("best") + slack)
            .select("plat", "plon", F.col("cell").alias("parent"), "best")
        )
    leaf = spots.select(F.col(f"c{len(_LEVELS) - 1}").alias("parent"), "lat", "lon", "address_id")
    pairs = front.join(leaf, "parent").select(
        "plat",
        "plon",
        F.struct(
            _haversine(plat, plon, F.col("lat"), F.col("lon")).alias("h"), "address_id"
        ).alias("hit"),
    )
    nearest = pairs.groupBy("plat", "plon").agg(F.min("hit").alias("hit"))
    return places.join(nearest, ["plat", "plon"], "left").select(
        "point_id",
        F.col("hit.address_id").alias("address_id"),
        (2 * EARTH_KM * F.asin(F.sqrt(F.least(F.col("hit.h"), F.lit(1.0))))).alias("distance_km"),
    )


def reverse_geocode(points: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Point -> attributes of the nearest address, NULL when there is none."""
    nearest = nearest_address(points, gazetteer)
    attributes = gazetteer.drop("latitude", "longitude")
    return nearest.join(attributes, "address_id", "left")
