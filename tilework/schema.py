"""Frozen item schemas, the two collections, and conforming of any input to them.

A schema is the only source of column names, order and types. Sources are read by
name: a column that no source has becomes a typed null, and the output order is the
schema's. Helper columns are computed here, so every writer computes them alike.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .functions.geo import envelope_of_geojson, hilbert

_LINKS = "array<struct<href:string,rel:string,title:string,type:string>>"

# The item schemas, name and type in published order.
L2A_COLUMNS = [
    ("thumbnail_url", "string"),
    ("type", "string"),
    ("stac_version", "string"),
    ("stac_extensions", "array<string>"),
    ("id", "string"),
    ("bbox", "array<double>"),
    ("links", _LINKS),
    ("collection", "string"),
    ("datetime", "timestamp"),
    ("platform", "string"),
    ("proj:epsg", "bigint"),
    ("instruments", "array<string>"),
    ("s2:mgrs_tile", "string"),
    ("constellation", "string"),
    ("s2:granule_id", "string"),
    ("eo:cloud_cover", "double"),
    ("s2:datatake_id", "string"),
    ("s2:product_uri", "string"),
    ("s2:datastrip_id", "string"),
    ("s2:product_type", "string"),
    ("sat:orbit_state", "string"),
    ("s2:datatake_type", "string"),
    ("s2:generation_time", "string"),
    ("sat:relative_orbit", "bigint"),
    ("s2:water_percentage", "double"),
    ("s2:mean_solar_zenith", "double"),
    ("s2:mean_solar_azimuth", "double"),
    ("s2:processing_baseline", "string"),
    ("s2:snow_ice_percentage", "double"),
    ("s2:vegetation_percentage", "double"),
    ("s2:thin_cirrus_percentage", "double"),
    ("s2:cloud_shadow_percentage", "double"),
    ("s2:nodata_pixel_percentage", "double"),
    ("s2:unclassified_percentage", "double"),
    ("s2:dark_features_percentage", "double"),
    ("s2:not_vegetated_percentage", "double"),
    ("s2:degraded_msi_data_percentage", "double"),
    ("s2:high_proba_clouds_percentage", "double"),
    ("s2:reflectance_conversion_factor", "double"),
    ("s2:medium_proba_clouds_percentage", "double"),
    ("s2:saturated_defective_pixel_percentage", "double"),
    ("assets", "string"),
    ("_month", "tinyint"),
    ("_hilbert", "bigint"),
    ("geometry", "binary"),
]
C1_COLUMNS = [
    ("thumbnail_url", "string"),
    ("type", "string"),
    ("stac_version", "string"),
    ("stac_extensions", "array<string>"),
    ("id", "string"),
    ("bbox", "array<double>"),
    ("links", _LINKS),
    ("collection", "string"),
    ("datetime", "timestamp"),
    ("created", "timestamp"),
    ("updated", "timestamp"),
    ("platform", "string"),
    ("constellation", "string"),
    ("instruments", "array<string>"),
    ("grid:code", "string"),
    ("mgrs:utm_zone", "bigint"),
    ("mgrs:latitude_band", "string"),
    ("mgrs:grid_square", "string"),
    ("proj:epsg", "bigint"),
    ("proj:centroid", "struct<lat:double,lon:double>"),
    ("eo:cloud_cover", "double"),
    ("s2:tile_id", "string"),
    ("s2:degraded_msi_data_percentage", "double"),
    ("s2:nodata_pixel_percentage", "double"),
    ("s2:saturated_defective_pixel_percentage", "double"),
    ("s2:dark_features_percentage", "double"),
    ("s2:cloud_shadow_percentage", "double"),
    ("s2:vegetation_percentage", "double"),
    ("s2:not_vegetated_percentage", "double"),
    ("s2:water_percentage", "double"),
    ("s2:unclassified_percentage", "double"),
    ("s2:medium_proba_clouds_percentage", "double"),
    ("s2:high_proba_clouds_percentage", "double"),
    ("s2:thin_cirrus_percentage", "double"),
    ("s2:snow_ice_percentage", "double"),
    ("s2:product_type", "string"),
    ("s2:processing_baseline", "string"),
    ("s2:product_uri", "string"),
    ("s2:generation_time", "string"),
    ("s2:datatake_id", "string"),
    ("s2:datatake_type", "string"),
    ("s2:datastrip_id", "string"),
    ("s2:reflectance_conversion_factor", "double"),
    ("view:azimuth", "double"),
    ("view:incidence_angle", "double"),
    ("view:sun_azimuth", "double"),
    ("view:sun_elevation", "double"),
    ("storage:platform", "string"),
    ("storage:region", "string"),
    ("storage:requester_pays", "boolean"),
    ("processing:software", "string"),
    ("earthsearch:payload_id", "string"),
    ("assets", "string"),
    ("_month", "tinyint"),
    ("_hilbert", "bigint"),
    ("_tile", "string"),
    ("geometry", "binary"),
]
#: Columns of the statistics tables, name and type.
STATS_COLUMNS = [
    ("mgrs_tile", "string"),
    ("year", "smallint"),
    ("month", "tinyint"),
    ("scene_count", "int"),
    ("min_cloud_cover", "smallint"),
    ("median_cloud_cover", "smallint"),
    ("mean_cover", "smallint"),
    ("max_cover", "smallint"),
    ("best_item_id", "string"),
    ("best_item_date", "date"),
]
PERCENT_COLUMNS = ("min_cloud_cover", "median_cloud_cover", "mean_cover", "max_cover")


@dataclass(frozen=True)
class Collection:
    """Everything that differs between the published collections."""

    name: str
    columns: tuple
    tile_column: str
    id_pattern: str  # groups: tile, day as YYYYMMDD
    zone_split: bool
    sort_keys: tuple
    row_group_rows: int
    month_aligned: bool
    lookback_field: str
    monthly_live: bool
    live_zstd_level: int
    key_root: str  # of object keys in an inventory
    version_column: str = "s2:generation_time"
    metric_column: str = "eo:cloud_cover"
    nodata_column: str = "s2:nodata_pixel_percentage"

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in self.columns])


L2A = Collection(
    "sentinel-2-l2a", tuple(L2A_COLUMNS), "s2:mgrs_tile", r"^S2[A-Z]_(\d{1,2}[A-Z]{3})_(\d{8})_\d+_L2A$",
    True, ("_month", "s2:mgrs_tile", "_hilbert"), 6144, False, "datetime", False, 18, "sentinel-s2-l2a-cogs/",
)
C1 = Collection(
    "sentinel-2-c1-l2a", tuple(C1_COLUMNS), "_tile", r"^S2[A-Z]_T(\d{1,2}[A-Z]{3})_(\d{8})T\d{6}_L2A$",
    False, ("_tile", "datetime"), 6000, False, "created", True, 3, "sentinel-2-c1-l2a/",
)
COLLECTIONS = {c.name: c for c in (L2A, C1)}
DEFAULT = L2A.name


def collection(name: str) -> Collection:
    if name not in COLLECTIONS:
        raise ValueError(f"unknown collection {name!r}; valid: {', '.join(COLLECTIONS)}")
    return COLLECTIONS[name]


def q(name: str) -> Column:
    """A column by its exact name, colons and dots included."""
    return F.col(f"`{name}`")


def read_by_name(frames: list[DataFrame]) -> DataFrame:
    """Union of frames by column name; absent columns are null."""
    if not frames:
        raise ValueError("nothing to union")
    # select: a bare range is a typed dataset, which a union by name cannot widen
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.select("*") for f in frames])


def conform(df: DataFrame, columns, computed: dict[str, Column] | None = None) -> DataFrame:
    """``columns`` (name, type) in order: cast where present, computed where given, else a typed null."""
    computed, have = computed or {}, set(df.columns)
    picked = []
    for name, kind in columns:
        if name in computed:
            value = computed[name]
        else:
            value = q(name) if name in have else F.lit(None)
        picked.append(value.cast(kind).alias(name))
    return df.select(picked)


def conform_items(df: DataFrame, config: Collection) -> DataFrame:
    """Items on their collection's schema, with the month and the locality key computed."""
    where = {c: q(c) for c in df.columns}
    computed: dict = {"_month": F.month(q("datetime"))}
    if "bbox" in where:
        box = q("bbox")
        centre = lambda i, j: (F.get(box, F.lit(i)) + F.get(box, F.lit(j))) / 2
        computed["_hilbert"] = hilbert(centre(0, 2), centre(1, 3))
    return conform(df, config.columns, computed)


def upgrade_stats(df: DataFrame) -> DataFrame:
    """A statistics table of any earlier layout on the present schema.

    Percents may be doubles or missing, and the best item may carry a timestamp in
    place of a date.
    """
    from .functions.scalars import percent

    have = set(df.columns)
    computed = {c: percent(q(c)) for c in PERCENT_COLUMNS if c in have}
    if "best_item_date" not in have and "best_item_datetime" in have:
        computed["best_item_date"] = F.to_date("best_item_datetime")
    return conform(df, STATS_COLUMNS, computed)


def keep_star_then(df: DataFrame, last: str = "geometry") -> DataFrame:
    """All columns with ``last`` moved to the end."""
    return df.select(*[q(c) for c in df.columns if c != last], q(last))


_PROPERTIES = "map<string,string>"


def normalise(items: DataFrame, config: Collection, column: str = "value") -> DataFrame:
    """Rows on the collection's data columns from item documents (JSON strings in ``column``).

    Fallbacks of the first collection: the tile from three grid fields, the orbit from
    the product name, the zenith from the sun's elevation, the azimuth from the sun's.
    The second strips its grid prefix. An item without any tile stops the job.
    """
    doc = F.col(column)
    text = lambda path: F.get_json_object(doc, f"$.{path}")
    props = F.from_json(text("properties"), _PROPERTIES)
    prop = lambda name: props[F.lit(name)]
    grid = F.concat(prop("mgrs:utm_zone"), prop("mgrs:latitude_band"), prop("mgrs:grid_square"))
    if config is L2A:
        given = F.nullif(prop("s2:mgrs_tile"), F.lit(""))
    else:
        given = F.nullif(F.regexp_replace(prop("grid:code"), "^MGRS-", ""), F.lit(""))
    tile = F.coalesce(given, grid)
    told = F.when(tile.isNull(), F.raise_error(F.concat(F.coalesce(text("id"), F.lit("<unknown id>")), F.lit(": no tile field")))).otherwise(tile)
    links = F.from_json(text("links"), _LINKS)
    orbit = F.regexp_extract(prop("s2:product_uri"), r"_R(\d{3})_", 1)
    computed = {
        "assets": F.coalesce(text("assets"), F.lit("{}")),
        "thumbnail_url": text("assets.thumbnail.href"),
        "type": F.lit("Feature"),
        "stac_version": text("stac_version"),
        "stac_extensions": F.coalesce(F.from_json(text("stac_extensions"), "array<string>"), F.array().cast("array<string>")),
        "id": text("id"),
        "bbox": F.from_json(text("bbox"), "array<double>"),
        "links": F.filter(
            F.coalesce(links, F.array().cast(_LINKS)),
            lambda x: ~F.coalesce(x["rel"].isin("next", "prev", "root", "parent"), F.lit(False)),
        ),
        "collection": F.lit(config.name),
        "datetime": F.to_timestamp(prop("datetime")),
        "instruments": F.coalesce(F.from_json(prop("instruments"), "array<string>"), F.array().cast("array<string>")),
        config.tile_column: told,
    }
    if config is L2A:
        computed |= {
            "sat:relative_orbit": F.coalesce(prop("sat:relative_orbit").try_cast("bigint"), orbit.try_cast("bigint")),
            "s2:mean_solar_zenith": F.coalesce(
                prop("s2:mean_solar_zenith").try_cast("double"), 90.0 - prop("view:sun_elevation").try_cast("double")
            ),
            "s2:mean_solar_azimuth": F.coalesce(prop("s2:mean_solar_azimuth"), prop("view:sun_azimuth")).try_cast("double"),
        }
    else:
        computed |= {
            "created": F.to_timestamp(prop("created")),
            "updated": F.to_timestamp(prop("updated")),
            "proj:centroid": F.from_json(prop("proj:centroid"), "struct<lat:double,lon:double>"),
        }
    out = []
    for name, kind in config.columns:
        if name in ("_month", "_hilbert"):
            continue
        if name == "geometry":
            out.append(text("geometry").alias("_geometry_json"))
            continue
        value = computed.get(name)
        if value is None:
            value = prop(name) if kind == "string" else prop(name).try_cast(kind)
        out.append(value.cast(kind).alias(name))
    return items.select(*out).withColumn("_envelope", envelope_of_geojson(F.col("_geometry_json")))


def unknown_properties(items: DataFrame, config: Collection, column: str = "value") -> DataFrame:
    """``property, n``: upstream properties that the schema does not know, with their counts."""
    known = F.array(*[F.lit(n) for n, _ in config.columns])
    keys = F.map_keys(F.from_json(F.get_json_object(column, "$.properties"), _PROPERTIES))
    return items.select(F.explode(F.array_except(keys, known)).alias("property")).groupBy("property").agg(F.count("*").alias("n"))
