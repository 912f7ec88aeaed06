"""Static inputs as tables: routes and stops from nested JSON, an overlay from a second provider, roads, households."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import PLANE_LATITUDE, plane_cell
from ..functions.names import electric_number

#: Road classes on which nobody walks.
CLOSED_ROADS = ("motorway", "motorway_link", "construction", "proposed", "platform", "elevator")
_TOPOLOGY = "nbusstop map<string,array<string>>, bus map<string,array<string>>, route map<string,array<string>>"
_STOP = "stopId:string,stopName:string,name:string,latitude:double,lat:double,longitude:double,lon:double,`order`:int"
_ROUTE = "mappedFrom:string,internalRouteId:string,naviRouteNumber:string,displayRouteNumber:string,naviTransportTypeId:string"
_OVERLAY = f"routes array<struct<{_ROUTE},races:array<struct<raceType:string,naviRaceType:string,stops:array<struct<{_STOP}>>>>>>"
#: Fixed value: routes of a second provider that are meant as an overlay.
OVERLAID = "navi-overlay"


def _entries(document: DataFrame, field: str) -> DataFrame:
    return document.select(F.explode(f"d.{field}").alias("id", "x"))


def parse_topology(document: DataFrame, json: str = "value") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stops, routes and route stops of a document with `nbusstop` {id: [name, lon, lat, slug]}, `bus` {id: [.., number, .., .., .., type]}
    and `route` {key: [route, stop, direction, order]}.  Entries of unknown routes or stops are left out."""
    parsed = document.select(F.from_json(json, _TOPOLOGY).alias("d"))
    x = F.col("x")
    stops = _entries(parsed, "nbusstop").select(
        F.col("id").alias("stop_id"), F.coalesce(F.get(x, 0), F.col("id")).alias("stop_name"), F.get(x, 2).cast("double").alias("stop_lat"), F.get(x, 1).cast("double").alias("stop_lon"), F.get(x, 3).alias("slug")
    )
    kind = F.coalesce(F.get(x, 5).try_cast("int"), F.lit(0))
    routes = _entries(parsed, "bus").select(
        F.col("id").alias("route_id"), F.coalesce(F.get(x, 1), F.col("id")).alias("number"), electric_number(F.coalesce(F.get(x, 1), F.col("id")), kind).alias("route"), kind.alias("transport_type")
    )
    rows = _entries(parsed, "route").select(F.get(x, 0).alias("route_id"), F.get(x, 1).alias("stop_id"), F.get(x, 2).cast("int").alias("direction"), F.get(x, 3).cast("int").alias("stop_order"))
    placed = rows.join(routes.select("route_id", "route"), "route_id").join(stops.drop("slug"), "stop_id")
    return stops, routes, placed


def overlay_direction(race: Column, index: Column) -> Column:
    """The direction that a race's letter stands for: A and C one way, B and D the other; else the race's place."""
    letter = F.upper(race)
    return F.when(letter.isin("A", "C"), 0).when(letter.isin("B", "D"), 1).otherwise(index)


def parse_overlay(document: DataFrame, json: str = "value") -> DataFrame:
    """Route stops of a second provider's document: routes of races of stops.  Only routes mapped as an overlay count, and only with an id of ours.
    Types 2 and 3 are our 1 and 2, all others 0."""
    parsed = document.select(F.from_json(json, _OVERLAY).alias("d")).select(F.explode("d.routes").alias("r"))
    parsed = parsed.where((F.col("r.mappedFrom") == OVERLAID) & (F.trim("r.internalRouteId") != ""))
    kind = F.when(F.col("r.naviTransportTypeId") == "2", 1).when(F.col("r.naviTransportTypeId") == "3", 2).otherwise(0)
    races = parsed.select("r", kind.alias("transport_type"), F.posexplode("r.races").alias("race", "x"))
    direction = overlay_direction(F.coalesce("x.raceType", "x.naviRaceType"), F.col("race"))
    stops = races.select("r", "transport_type", direction.alias("direction"), F.posexplode("x.stops").alias("place", "s"))
    number = F.coalesce("r.naviRouteNumber", "r.displayRouteNumber")
    return stops.where(F.trim("s.stopId") != "").select(
        F.col("r.internalRouteId").alias("route_id"),
        number.alias("number"),
        F.coalesce("r.displayRouteNumber", electric_number(number, F.col("transport_type"))).alias("route"),
        "transport_type",
        F.col("s.stopId").alias("stop_id"),
        F.coalesce("s.stopName", "s.name", "s.stopId").alias("stop_name"),
        F.coalesce("s.latitude", "s.lat").alias("stop_lat"),
        F.coalesce("s.longitude", "s.lon").alias("stop_lon"),
        "direction",
        F.coalesce("s.order", "place").alias("stop_order"),
    )


def with_overlay(base: DataFrame, overlay: DataFrame, stops: DataFrame | None = None) -> DataFrame:
    """Base route stops and the overlay's, of routes that the base has as well.  A stop that is known (stops, else those of base) keeps its
    name and place; one that only the overlay has is where the overlay puts it first, by route, direction and order."""
    place = F.struct("stop_name", "stop_lat", "stop_lon")
    known = (base if stops is None else stops).groupBy("stop_id").agg(F.min(place).alias("__known"))
    fresh = overlay.groupBy("stop_id").agg(F.min(F.struct("route_id", "direction", "stop_order", place.alias("p")))["p"].alias("__fresh"))
    found = overlay.join(known, "stop_id", "left").join(fresh, "stop_id").withColumn("__p", F.coalesce("__known", "__fresh"))
    placed = found.withColumns({c: F.col(f"__p.{c}") for c in ("stop_name", "stop_lat", "stop_lon")}).select(*overlay.columns)
    return base.unionByName(placed.select(*(c for c in placed.columns if c in base.columns)), allowMissingColumns=True)


def parse_ways(document: DataFrame, json: str = "value", closed: tuple[str, ...] = CLOSED_ROADS) -> DataFrame:
    """Road steps (way, place, a_lat, a_lon, b_lat, b_lon) of a document of `elements` with tags and geometry; closed classes go."""
    schema = "elements array<struct<type:string,id:bigint,tags:map<string,string>,geometry:array<struct<lat:double,lon:double>>>>"
    ways = document.select(F.explode(F.from_json(json, schema)["elements"]).alias("e")).where("e.type = 'way' and trim(e.tags['highway']) <> ''")
    points = ways.where(~F.col("e.tags")["highway"].isin(*closed)).select(F.col("e.id").alias("way"), F.col("e.geometry").alias("g"))
    steps = points.where(F.size("g") > 1).select("way", "g", F.explode(F.sequence(F.lit(0), F.size("g") - 2)).alias("place"))
    end = lambda k, c: F.col("g")[F.col("place") + k][c].alias(f"{'ab'[k]}_{c}")
    return steps.select("way", "place", end(0, "lat"), end(0, "lon"), end(1, "lat"), end(1, "lon"))


def household_cells(document: DataFrame, json: str = "value", metres: float = 250.0, latitude: float = PLANE_LATITUDE) -> DataFrame:
    """Cells (x, y) of the plane of contours with the sum of their buildings' flats; a building counts as one household at least."""
    rows = document.select(F.explode(F.from_json(json, "array<struct<lat:double,lon:double,flats:int>>")).alias("h")).where("h.lat is not null and h.lon is not null")
    flats = F.greatest(F.lit(1), F.coalesce("h.flats", F.lit(1)))
    x, y = plane_cell(F.col("h.lat"), F.col("h.lon"), metres, latitude)
    return rows.groupBy(x.alias("x"), y.alias("y")).agg(F.sum(flats).alias("households"))
