"""Filters and derived columns on pixels and lakes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mereflow.functions.scalars import finite

PIXEL_KEY = ("tile_number", "range_index", "azimuth_index")
#: Pixel classes and the roles that they play by default.
LAND_EDGE, WATER_EDGE, OPEN_WATER, DARK, LOW_COHERENCE_EDGE, LOW_COHERENCE = 2, 3, 4, 5, 6, 7
ROLES = {"water": (3, 4, 6, 7), "dark": (5,), "interior": (4, 5), "for_hull": (2, 3, 4, 5, 6, 7), "for_wse": (3, 4, 6, 7), "for_area": (2, 3, 4, 5, 6, 7)}


def river_only(vec: DataFrame, key: Iterable[str] = PIXEL_KEY) -> DataFrame:
    """Keys of pixels that belong to a river: a reach id, unless it ends in 3 (a lake on a reach)."""
    return vec.where(F.col("reach_id").isNotNull() & ~F.col("reach_id").endswith("3")).select(*key)


def reject_river(pixels: DataFrame, vec: DataFrame, key: Iterable[str] = PIXEL_KEY) -> DataFrame:
    return pixels.join(river_only(vec, key).distinct(), list(key), "left_anti")


def located(pixels: DataFrame, columns: Iterable[str] = ("longitude", "latitude", "height", "illumination_time"), most: dict[str, float] | None = None) -> DataFrame:
    """Rows whose columns are neither null nor NaN and whose integer columns are below their fill values."""
    most = {"classification": 10, "range_index": 999999, "azimuth_index": 999999} if most is None else most
    keep = F.lit(True)
    for c in columns:
        keep = keep & F.col(c).isNotNull() & ~F.isnan(c)
    for c, top in most.items():
        keep = keep & (F.col(c) <= top)
    return pixels.where(keep)


def clean_flags(pixels: DataFrame, masks: dict[str, int]) -> DataFrame:
    """Rows without a masked bit in any flag; a mask of 0 stands for all bits."""
    keep = F.lit(True)
    for c, mask in masks.items():
        keep = keep & ((F.col(c) == 0) if mask == 0 else (F.col(c).bitwiseAND(F.lit(mask)) == 0))
    return pixels.where(keep)


def of_classes(pixels: DataFrame, classes: Iterable[int], bright_land: bool = True) -> DataFrame:
    """Rows of the classes; with ``bright_land`` false, without those that its flag marks."""
    out = pixels.where(F.col("classification").isin(list(classes)))
    return out if bright_land else out.where("bright_land_flag = 0")


def with_roles(pixels: DataFrame, roles: dict[str, tuple[int, ...]] | None = None) -> DataFrame:
    """A boolean ``is_<role>`` per role and the two class variants for area sums."""
    c = F.col("classification")
    out = {f"is_{k}": c.isin(list(v)) for k, v in (roles or ROLES).items()}
    out["as_full_water"] = F.when(c.isin(LAND_EDGE, WATER_EDGE), WATER_EDGE).otherwise(OPEN_WATER)
    out["without_dw"] = F.when(c == DARK, 0).otherwise(c)
    return pixels.withColumns(out)


def inundated_area(classes: Iterable[int] = (LAND_EDGE, WATER_EDGE)) -> Column:
    return F.when(F.col("classification").isin(list(classes)), F.col("pixel_area") * F.col("water_frac")).otherwise(F.col("pixel_area"))


def phase_height_std(bad: float = 1e5) -> Column:
    """Height deviation from phase noise; ``bad`` where it is not a positive number."""
    s = F.abs(F.col("phase_noise_std") * F.col("dheight_dphase"))
    ok = (F.col("phase_noise_std") > 0) & (s > 0) & ~F.isnan(s) & (s < float("inf"))
    return F.when(ok, s).otherwise(bad)


def corrected_height(load: str = "load_tide_fes") -> Column:
    """Height less geoid and tides; null unless all are finite."""
    parts = [finite(F.col(c)) for c in ("height", "geoid", "solid_earth_tide", "pole_tide", load)]
    out = parts[0]
    for p in parts[1:]:
        out = out - p
    return out


def cross_track_window(pixels: DataFrame, keys: list[str], low: float | None, high: float | None, size_range: int | None = None) -> DataFrame:
    """Pixels inside the cross-track window, with ``partial_f`` = 1 for objects that the window cuts.

    Without a window, objects that touch the first or last range column (the last only if ``size_range`` is known), or a row
    flagged as the pass' border (``border``), are partial.
    """
    if low is not None or high is not None:
        x = F.abs("cross_track")
        inside = F.lit(True) if low is None else x >= low
        inside = inside if high is None else inside & (x <= high)
        cut, kept = ~inside, pixels.where(inside)
    else:
        last = F.lit(False) if size_range is None else F.col("range_index") == size_range - 1
        cut, kept = (F.col("range_index") == 0) | last, pixels
        if "border" in pixels.columns:
            cut = cut | F.col("border")
    return kept.join(pixels.groupBy(*keys).agg(F.max(cut.cast("int")).alias("partial_f")), keys)


def valid_geolocation(pixels: DataFrame, keys: list[str], columns: Iterable[str] = ("lon_imp", "lat_imp", "height_imp")) -> DataFrame:
    """Pixels with finite improved position, with ``validity``: 2 if all of the object's are, else 1. Objects without any go."""
    good = F.lit(True)
    for c in columns:
        good = good & finite(F.col(c)).isNotNull()
    return pixels.where(good).join(pixels.groupBy(*keys).agg((F.min(good.cast("int")) + 1).alias("validity")), keys)


def large_objects(pixels: DataFrame, keys: list[str], min_size_km2: float, interior: Column | None = None) -> DataFrame:
    """Keys of objects of enough interior water that are not a single row or column."""
    area = F.sum(F.when(F.lit(True) if interior is None else interior, F.col("pixel_area")))
    sizes = pixels.groupBy(*keys).agg((area / 1e6).alias("size_km2"), F.min("range_index").alias("r0"), F.max("range_index").alias("r1"), F.min("azimuth_index").alias("a0"), F.max("azimuth_index").alias("a1"))
    return sizes.where((F.col("size_km2") >= min_size_km2) & (F.col("r0") < F.col("r1")) & (F.col("a0") < F.col("a1"))).select(*keys, "size_km2")


def near_range_border(water: DataFrame, min_cross_track: float, keys: Iterable[str] = ("tile_number",)) -> DataFrame:
    """Per azimuth line the first range kept and the last removed near the sensor; ``adjacent`` where they follow each other."""
    near = F.abs("cross_track") < min_cross_track
    lines = water.groupBy(*keys, "azimuth_index").agg(F.min(F.when(~near, F.col("range_index"))).alias("first_kept"), F.max(F.when(near, F.col("range_index"))).alias("last_removed"))
    return lines.withColumn("adjacent", F.coalesce(F.col("first_kept") == F.col("last_removed") + 1, F.lit(False)))


def remove_borders(water: DataFrame, min_cross_track: float, keys: Iterable[str] = ("tile_number",)) -> DataFrame:
    """Water beyond the near range, without first and last azimuth, last range, and the first kept pixel next to removed ones."""
    keys = list(keys)
    over = Window.partitionBy(*keys)
    kept = water.withColumns({"az_max": F.max("azimuth_index").over(over), "r_max": F.max("range_index").over(over)})
    kept = kept.where((F.abs("cross_track") >= min_cross_track) & (F.col("azimuth_index") != 0) & (F.col("azimuth_index") != F.col("az_max")) & (F.col("range_index") != F.col("r_max")))
    rim = near_range_border(water, min_cross_track, keys).where("adjacent").select(*keys, "azimuth_index", F.col("first_kept").alias("range_index"))
    return kept.drop("az_max", "r_max").join(rim, [*keys, "azimuth_index", "range_index"], "left_anti")


def in_box(df: DataFrame, lon_min: float, lon_max: float, lat_min: float, lat_max: float) -> DataFrame:
    return df.where(F.col("longitude").between(lon_min, lon_max) & F.col("latitude").between(lat_min, lat_max))


def observed_first(lakes: DataFrame, keys: list[str], missing: str = "no_data") -> DataFrame:
    """Unobserved rows go where the same lake has an observed one; of several unobserved one stays."""
    seen = F.max((F.col("obs_id") != missing).cast("int")).over(Window.partitionBy(*keys))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy((F.col("obs_id") == missing).cast("int"), *[c for c in lakes.columns if c not in keys]))
    return lakes.withColumns({"__seen": seen, "__rank": rank}).where((F.col("obs_id") != missing) | ((F.col("__seen") == 0) & (F.col("__rank") == 1))).drop("__seen", "__rank")


def storage_input(value: Column, least: float = -9e11) -> Column:
    """The value, or null where it is no number that storage change can use."""
    v = finite(value)
    return F.when(v >= least, v)


def storage_uncertainty(uncertainty: Column, value: Column) -> Column:
    """The uncertainty, or the value itself where that is bad."""
    return F.coalesce(storage_input(uncertainty), value)


#: Prior-lake columns with the limit below which they are unknown.
PRIOR_LIMITS = {"res_id": 0, "lon": -180.0, "lat": -90.0, "ref_wse": 0, "ref_wse_u": 0, "ref_area": 0, "ref_area_u": 0, "ds_t0": -9e7, "storage": 0, "overlap_avg_l": 0, "nb_tiles_l": 0, "overlap_avg_r": 0, "nb_tiles_r": 0}
PRIOR_TEXTS = ("names", "date_t0", "reach_id_list")


def normalise_prior(prior: DataFrame, missing: str = "no_data") -> DataFrame:
    """Sentinels of the prior lakes to null, for the columns that are there."""
    out = {c: F.when(F.col(c) >= low, F.col(c)) for c, low in PRIOR_LIMITS.items() if c in prior.columns}
    out |= {c: F.when(~F.col(c).isin("", missing), F.col(c)) for c in PRIOR_TEXTS if c in prior.columns}
    return prior.withColumns(out)


def id_predicate(column: str, prefix: str | None = None, listed: str | None = None) -> Column:
    """Ids by prefix, or ``;``-separated lists by member."""
    keep = F.lit(True)
    if prefix is not None:
        keep = keep & F.col(column).startswith(prefix)
    return keep if listed is None else keep & F.array_contains(F.split(column, ";"), listed)
