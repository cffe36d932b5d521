"""Scans, checks, merges and writes of products, and the whole jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from mereflow import scratch
from mereflow.functions.scalars import finite, hour_bucket, lon_180, range_spacing, surface_elevation
from mereflow.operators import aggregates as A
from mereflow.operators import geometry as G
from mereflow.operators import geoloc as O
from mereflow.operators import labels as L
from mereflow.operators import link as K
from mereflow.operators import neighbours as N
from mereflow.operators import select as P

#: Fill values of the written products.
FILL_REAL, FILL_INT, FILL_TEXT = -999999999999.0, -999999999, "no_data"
KINDS = ("Obs", "Prior", "Unassigned", "Edge", "PIXCVec")


def read(spark: SparkSession, path: str, schema: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """A product table; with a schema no file is opened to plan, with columns only those are read."""
    out = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    return out.select(*columns) if columns else out


#: Columns that the floodplain reads of a pixel cloud, beside its keys and position.
SCANNED = ("classification", "pixel_area", "incidence", "cross_track", "pole_tide", "load_tide_got", "load_tide_fes", "solid_earth_tide", "geoid", "illumination_time")


def floodplain_scan(pixels: DataFrame, vec: DataFrame, keys: list[str], nominal: float, near_range: float, altitude: float, load_tide: str = "both") -> DataFrame:
    """Water pixels (classes above 1) at the complement's positions, with elevation, range spacing and hour.

    Pixels without a complement row go, and so do rows with a null or NaN in any column that is read.
    """
    place = ("longitude", "latitude", "height")
    own = pixels.where("classification > 1").select(*keys, *SCANNED).join(vec.select(*keys, *place), keys).dropna(subset=[*SCANNED, *place])
    return own.withColumns(
        {
            "longitude": lon_180(F.col("longitude")),
            "elevation": surface_elevation(*(F.col(c) for c in ("height", "geoid", "solid_earth_tide", "pole_tide", "load_tide_got", "load_tide_fes")), load_tide),
            "range_spacing": range_spacing(F.lit(nominal), F.col("incidence"), F.lit(altitude), F.lit(near_range), F.col("range_index")),
            "hour": hour_bucket(F.col("illumination_time")),
        }
    )


def edge_scan(edge: DataFrame, keys: list[str], hours: float = 24.0, time: str = "illumination_time") -> DataFrame:
    """Edge pixels within ``hours`` of their swath's first time; tile order is the tile number's."""
    first = edge.groupBy(*keys).agg(F.min(time).alias("__first"))
    return edge.join(first, keys).where(F.col(time) - F.col("__first") <= hours * 3600).drop("__first")


def lakes_of_basin(lakes: DataFrame, prefix: str) -> DataFrame:
    """Usable pass-level lakes of a basin, by predicates that reach the scan."""
    return lakes.where(F.col("lake_id").startswith(prefix) & (F.col("time") > 0) & (F.col("wse") > -1e10) & (F.col("area_total") > 0))


def name_fields(name: Column) -> dict[str, Column]:
    """cycle, pass, place, start, stop, crid and counter from a product's file name or path."""
    pattern = r"_(\d{3})_(\d{3})_([0-9A-Z]+)_(\d{8}T\d{6})_(\d{8}T\d{6})_([A-Za-z0-9]+)_(\d{2})[^/]*$"
    part = lambda k: F.nullif(F.regexp_extract(name, pattern, k), F.lit(""))
    return {"cycle": part(1).cast("int"), "pass": part(2).cast("int"), "place": part(3), "start": part(4), "stop": part(5), "crid": part(6), "counter": part(7).cast("int")}


def complete_tiles(files: DataFrame, keys: list[str], continent: str | None = None) -> DataFrame:
    """Keys of tiles that have all five kinds, of the given continent if any (``continents`` is a ``;`` list)."""
    own = files if continent is None else files.where(F.array_contains(F.split("continents", ";"), continent))
    return own.groupBy(*keys).agg(F.size(F.collect_set(F.when(F.col("kind").isin(*KINDS), F.col("kind")))).alias("n")).where(F.col("n") == len(KINDS)).select(*keys)


def to_basins(files: DataFrame, basins: DataFrame) -> DataFrame:
    """(file, basin): a file with many basin codes goes to every basin whose code one of them starts with."""
    codes = files.select("file", F.explode(F.split("basin_code", ";")).alias("code")).distinct()
    length = basins.select("basin", F.length("basin").alias("n"))
    sizes = [r["n"] for r in length.select("n").distinct().collect()]  # as many as code lengths
    cut = codes.select("file", F.explode(F.array(*(F.substring("code", 1, n) for n in sizes))).alias("basin")) if sizes else codes.withColumnRenamed("code", "basin")
    return cut.join(basins.select("basin"), "basin").select("file", "basin").distinct()


def pair_files(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, left_file, right_file), null where a file has no partner."""
    return left.select(*keys, F.col("file").alias("left_file")).join(right.select(*keys, F.col("file").alias("right_file")), keys, "full_outer")


def for_sink(df: DataFrame, order: list[str], digits: int = 6) -> DataFrame:
    """Columns in product order, reals rounded, nulls and NaN as fill values; missing columns are filled."""
    types, out = dict(df.dtypes), []
    for c in order:
        t = types.get(c)
        if t is None:
            out.append(F.lit(FILL_TEXT).alias(c))
        elif t in ("double", "float"):
            out.append(F.coalesce(F.round(finite(F.col(c)), digits), F.lit(FILL_REAL)).alias(c))
        elif t in ("int", "bigint", "smallint", "tinyint"):
            out.append(F.coalesce(F.col(c), F.lit(FILL_INT).cast(t)).alias(c))
        elif t == "string":
            out.append(F.coalesce(F.col(c), F.lit(FILL_TEXT)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def write(df: DataFrame, path: str, order: list[str] | None = None, by: list[str] | None = None) -> None:
    """A product as Parquet, in folders by ``by``; with an order, filled and rounded first."""
    out = for_sink(df, order) if order else df
    (out.write.partitionBy(*by) if by else out.write).parquet(path)


def write_observed(df: DataFrame, path: str, extents: dict[str, str], order: list[str] | None = None, by: list[str] | None = None) -> dict:
    """Write a product and, beside it, a row of its own metadata: n_rows and the least and greatest value of each of ``extents`` {name: column}.

    The values are observed by the pass that writes, so nothing is read or computed twice. NaN counts as no value. The row is returned,
    and :func:`read_sidecar` reads it. Rows are dealt by their folder, so that a folder gets one file and not one of every task.
    """
    if by:
        df = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)
    watch = Observation()
    value = lambda c: finite(F.col(c).cast("double"))
    own = df.observe(watch, F.count(F.lit(1)).alias("n_rows"), *(f(value(c)).alias(f"{k}_{end}") for k, c in extents.items() for end, f in (("min", F.min), ("max", F.max))))
    write(own, path, order, by)
    row = watch.get
    schema = ", ".join(["n_rows long", *(f"{k}_{end} double" for k in extents for end in ("min", "max"))])
    df.sparkSession.createDataFrame([tuple(row[c.split()[0]] for c in schema.split(", "))], schema).write.parquet(f"{path}.meta")
    return row


def read_sidecar(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}.meta")


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Write a product in sorted buckets of its keys, as a table of the session's catalogue; joins and groups by all of the keys need no exchange then.

    Products that are to be joined need the same number of buckets.
    """
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    scratch.at_exit(spark, path)
    return spark.table(name)


def write_grid(grid: DataFrame, path: str, values: list[str], digits: int = 6) -> None:
    """A raster (ix, iy, x, y, values) as a Parquet table in the order of its cells, dealt by columns of cells; missing values are filled."""
    out = for_sink(grid, ["ix", "iy", "x", "y", *values], digits)
    out.repartitionByRange("ix", "iy").sortWithinPartitions("ix", "iy").write.parquet(path)


def export_points(pixels: DataFrame, columns: list[str], water_only: bool = False) -> DataFrame:
    """Chosen columns with the point as text."""
    own = pixels.where(F.col("classification").isin(3, 4, 6, 7)) if water_only else pixels
    return own.select(*columns, F.concat(F.lit("POINT("), F.col("longitude").cast("string"), F.lit(" "), F.col("latitude").cast("string"), F.lit(")")).alias("wkt"))


def metadata(files: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, coverage and extents as least and greatest, inputs as a sorted list)."""
    return files.groupBy(*keys).agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("lon_min").alias("lon_min"), F.max("lon_max").alias("lon_max"), F.array_join(F.array_sort(F.collect_set("file")), ";").alias("inputs"))


def inconsistent(files: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, sources, databases) of products whose inputs name more than one source or prior database."""
    n = files.groupBy(*keys).agg(F.count_distinct("source").alias("sources"), F.count_distinct("database").alias("databases"))
    return n.where("sources > 1 or databases > 1")


def require_one_source(files: DataFrame, keys: list[str]) -> DataFrame:
    """``files``, which fails when a product's inputs have more than one source."""
    n = files.groupBy(*keys).agg(F.count_distinct("source").alias("__n"))
    checked = n.select(*keys, F.assert_true(F.col("__n") <= 1, F.lit("inputs of more than one source")).alias("__ok"))
    return files.join(checked, keys).where("__ok is null").drop("__ok")


def merge(parts: list[DataFrame], continent: str | None = None, id_col: str = "lake_id", geometry: str | None = None) -> DataFrame:
    """Layers of the same columns as one; by continent digit, and without features that lack the geometry, if asked."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if continent is not None:
        out = out.where(F.col(id_col).startswith(continent))
    return out if geometry is None else out.where(F.col(geometry).isNotNull())


def combined_cloud(clouds: list[DataFrame], box: tuple[float, float, float, float], margin: float) -> DataFrame:
    """Points of all clouds in the box with a margin, with ``source`` and whether they are ``valid`` (finite z)."""
    x0, x1, y0, y1 = box
    own = [c.withColumns({"source": F.lit(k), "valid": finite(F.col("z")).isNotNull()}) for k, c in enumerate(clouds)]
    return merge(own).where(F.col("x").between(x0 - margin, x1 + margin) & F.col("y").between(y0 - margin, y1 + margin))


def pixel_lines(pixels: DataFrame, keys: list[str], reverse: Column) -> DataFrame:
    """Per azimuth line the r-th range with the r-th longitude; ``reverse`` pairs with the r-th from the other end."""
    line = [*keys, "azimuth_index"]
    up = F.row_number().over(Window.partitionBy(*line).orderBy("range_index"))
    down = F.row_number().over(Window.partitionBy(*line).orderBy(F.desc("range_index")))
    ranges = pixels.select(*line, "range_index", F.when(reverse, down).otherwise(up).alias("r"))
    lons = pixels.select(*line, "longitude", F.row_number().over(Window.partitionBy(*line).orderBy("longitude", "latitude")).alias("r"))
    return ranges.join(lons, [*line, "r"]).drop("r")


def row_spacing(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """Distance between pixels of adjacent ranges on the same line, per pixel after the first."""
    w = Window.partitionBy(*keys, "azimuth_index").orderBy("range_index")
    near = F.lag("range_index").over(w) == F.col("range_index") - 1
    d = F.sqrt((F.col("longitude") - F.lag("longitude").over(w)) ** 2 + (F.col("latitude") - F.lag("latitude").over(w)) ** 2)
    return pixels.select(*keys, "azimuth_index", "range_index", F.when(near, d).alias("spacing")).where("spacing is not null")


def sample_per_lake(pixels: DataFrame, keys: list[str], most: int, key: list[str]) -> DataFrame:
    """At most ``most`` pixels of each lake, by the least hash of the pixel's key: the same ones every time."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.md5(F.concat_ws("_", *key)), *key))
    return pixels.withColumn("__r", rank).where(F.col("__r") <= most).drop("__r")


# Jobs -----------------------------------------------------------------------------------------


def linked_cells(pixels: DataFrame, prior: DataFrame, key: str, size: float, least: float = 0.02) -> DataFrame:
    """(key, lake_id, area, overlap): how many pixels (key, id, x, y) of each object lie in each prior lake, where that is over ``least`` of its pixels."""
    links = K.ShapeLinks(pixels.withColumnRenamed(key, "obs_id"), prior, size, least)
    return G.expanded(links.met, "lake_id", links.members).select(F.col("obs_id").alias(key), "lake_id", "area", "overlap")


def tile_product(pixels: DataFrame, prior: DataFrame, min_size_km2: float = 0.0, size: float = 8.0) -> dict[str, DataFrame]:
    """The tile job, one plan over all tiles, from pixels with a plane position x, y and prior lakes (lake_id, rings) in that plane.

    ``obs``: lakes inside the tiles that overlap prior ones, with attributes, hull and the prior ids by decreasing overlap;
    ``unassigned``: those that overlap none; ``prior``: all prior lakes with the ids of their lakes, null where unobserved;
    ``vec``: every pixel of these lakes with the height that its geolocation is moved to; ``edge``: pixels of lakes that tile borders cut.
    """
    keys = ["tile_number", "label"]
    good = P.with_roles(P.located(pixels)).where("is_for_hull").drop("lake")
    labelled = scratch.save(L.lake_labels(good.where("is_water or is_dark")).withColumn("id", L.pixel_id()), "tile-labels")
    inside = labelled.join(L.border_flags(labelled).where("edge_loc is null").select(*keys), keys, "left_semi")
    keep = P.large_objects(inside, keys, min_size_km2, F.col("is_interior")).select(*keys)
    own = scratch.save(inside.join(keep, keys, "left_semi"), "tile-lakes")
    hulls = G.convex_hulls(own.select(*keys, "azimuth_index", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")), keys)
    lakes = A.lake_attributes(own, keys, P.corrected_height(), F.col("height_std")).join(hulls.hint("merge"), keys)
    lakes = scratch.save(lakes.withColumn("obs_id", F.col("label").cast("string")), "tile-attributes")
    links = K.ShapeLinks(own.withColumn("obs_id", F.col("label").cast("string")), prior, size)
    per_lake = G.expanded(links.per_lake(), "lake_id", links.members)
    return {
        "obs": lakes.join(links.per_object().hint("merge"), "obs_id"),
        "unassigned": lakes.join(links.objects().hint("merge"), "obs_id", "left_anti"),
        "prior": prior.select("lake_id").join(per_lake.hint("merge"), "lake_id", "left"),
        "vec": O.height_model(own, keys).select("tile_number", "range_index", "azimuth_index", "label", "height_target"),
        "edge": L.edge_pixels(labelled),
    }


def pass_product(edge: DataFrame, meta: DataFrame, keys: list[str], prior: DataFrame, size: float = 8.0) -> dict[str, DataFrame]:
    """The pass job: lakes that tile borders cut, merged along the pass.

    ``objects``: every merged lake with its attributes; ``prior``: a row per linked prior lake, the values of its
    observations fused; ``unassigned``: merged lakes without a prior one; ``vec``: the edge pixels with their merged lake's height,
    which update the tiles' complements.
    """
    names = L.merge_tiles(edge, L.tile_layout(meta, keys), keys)
    merged = scratch.save(edge.join(names, ["tile_number", "label"]), "pass-lakes")
    objects = A.lake_attributes(merged, [*keys, "merged"], P.corrected_height(), F.col("height_std"), scope=keys).withColumn("obs_id", F.col("merged").cast("string"))
    objects = scratch.save(objects, "pass-objects")
    # lakes of one shape are linked to the same objects, so their values are fused once
    links = K.ShapeLinks(merged.withColumn("obs_id", F.col("merged").cast("string")), prior, size)
    linked = objects.join(links.met.select("obs_id", "lake_id", "overlap").hint("merge"), "obs_id")
    fused = scratch.save(A.fuse_duplicates(linked, ["lake_id"], ["wse"], ["n_pix"], ["quality_f"], {"obs_id": "overlap"}), "fused")
    return {
        "objects": objects,
        "prior": G.expanded(fused, "lake_id", links.members).select(*fused.columns),
        "unassigned": objects.join(links.objects().hint("merge"), "obs_id", "left_anti"),
        "vec": O.height_model(merged, [*keys, "merged"]).select("tile_number", "range_index", "azimuth_index", "merged", "height_target"),
    }


def floodplain(points: DataFrame, resolution: float, k: int = 5, near: float = 10000.0, min_area: float = 0.0, widen: int = 1, classes: tuple[int, ...] = (3, 4, 5, 6, 7)) -> DataFrame:
    """Elevation between lowest and highest water, from scanned pixels with a plane position x, y and an elevation z.

    Borders and small regions off, then the shorelines' points, and around them the grid cells between the smallest and the widest
    extent of the regions, by inverse distances and with a quality flag.
    """
    water = P.remove_borders(P.of_classes(points, classes), near)
    regions = scratch.save(L.large_regions(L.lake_labels(water, diagonal=True), min_area), "water-regions")
    shore = G.boundary_cells(regions, ["label"]).where(finite(F.col("z")).isNotNull()).withColumn("id", L.pixel_id())
    shore = scratch.save(shore.select("id", "x", "y", "z"), "shore")
    place = [F.floor(F.col(c) / resolution).alias(f"i{c}") for c in ("x", "y")]
    mask = G.extent_between(regions.select(F.col("label").alias("id"), *place), widen)
    cells = N.grid(shore, resolution).join(mask, ["ix", "iy"], "left_semi")
    return N.idw(cells, shore, k, resolution).withColumn("quality", N.quality())
