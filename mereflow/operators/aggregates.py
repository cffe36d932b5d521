"""Aggregates over the pixels of an object, and fusion of lake rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mereflow.functions.scalars import finite
from mereflow.operators.select import DARK, LAND_EDGE, LOW_COHERENCE, LOW_COHERENCE_EDGE, OPEN_WATER, WATER_EDGE

#: Class groups of the area sums.
INTERIOR, EDGES, DARK_CLASSES = (OPEN_WATER, LOW_COHERENCE, LOW_COHERENCE_EDGE), (LAND_EDGE, WATER_EDGE), (DARK, 22, 23, 24)
#: Prior probabilities of the composite area model.
P_CORRECT, P_WATER, P_TRUE_FRACTION, DEM_STD = 0.9, 0.5, 0.5, 10.0
TINY = 2.22e-16
#: Phase derivatives whose mean is below this part of their mean size cancel: the object has no uncertainty by looks.
CANCELS = 1e-12


def metric(column: str, kind: str, percentile: float = 50.0) -> Column:
    """mean, median, sum, std, percentile, count or mode of a column; NaN is skipped by the first four.

    Medians, percentiles and modes keep a group's distinct values in one task; :func:`percentiles` and :func:`modes` do not.
    """
    c, clean = F.col(column), F.nanvl(F.col(column), F.lit(None).cast("double"))
    return {
        "mean": lambda: F.avg(clean),
        "median": lambda: F.median(clean),
        "sum": lambda: F.sum(clean),
        "std": lambda: F.stddev_pop(clean),
        "percentile": lambda: F.percentile(clean, percentile / 100),
        "count": lambda: F.count(c),
        "mode": lambda: F.mode(c, deterministic=True),
    }[kind]()


#: Rank error of the bracket in parts of a group, and how many of it lie between the bracket's ends and the wanted rank.
BRACKET, MARGIN = 10_000, 10


def percentiles(df: DataFrame, keys: list[str], wanted: dict[str, tuple[str, float]], beside: dict[str, Column] | None = None) -> DataFrame:
    """(keys, names, beside): exact interpolated percentiles {name: (column, part from 0 to 1)} of each group; null where a column has no value.

    A sketch of bounded size gives two values of the group on either side of the wanted rank. A second aggregate counts what
    lies below and on them and keeps what lies between, a few thousandths of a group, in which the wanted row is found. No task
    holds a group's values. Nulls and NaN are skipped. ``beside`` are further aggregates of ``df``, which the first of the two takes along.
    """
    beside = beside or {}
    own = df.withColumns({f"__v_{k}": F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for k, (c, _) in wanted.items()})
    away = MARGIN / BRACKET
    ends = own.groupBy(*keys).agg(*(a.alias(f"__x_{k}") for k, a in beside.items()), *(F.percentile_approx(f"__v_{k}", [max(0.0, q - away), min(1.0, q + away)], BRACKET).alias(f"__e_{k}") for k, (_, q) in wanted.items()), *(F.count(f"__v_{k}").alias(f"__n_{k}") for k in wanted))
    both = own.select(*keys, *(f"__v_{k}" for k in wanted)).join(ends, keys)
    parts = [F.first(f"__x_{k}").alias(k) for k in beside]
    for k, (_, q) in wanted.items():
        v, many = F.col(f"__v_{k}"), F.col(f"__n_{k}") * away > 5
        # in a small group, and at the ends, the bracket is open
        lo = F.when(many & F.lit(q > away), F.col(f"__e_{k}")[0]).otherwise(float("-inf"))
        hi = F.when(many & F.lit(q < 1 - away), F.col(f"__e_{k}")[1]).otherwise(float("inf"))
        parts += [F.count(F.when(v < lo, 1)).alias(f"__b_{k}"), F.count(F.when(v == lo, 1)).alias(f"__l_{k}"), F.sort_array(F.collect_list(F.when((v > lo) & (v < hi), v))).alias(f"__m_{k}"), F.max(lo).alias(f"__lo_{k}"), F.max(hi).alias(f"__hi_{k}"), F.max(f"__n_{k}").alias(f"__n_{k}")]
    found = both.groupBy(*keys).agg(*parts)
    out = []
    for k, (_, q) in wanted.items():
        c = lambda x, k=k: F.col(f"__{x}_{k}")
        place = (c("n") - 1) * F.lit(q)

        def value(rank, c=c):
            at = rank.cast("long") - c("b")
            between = at - c("l")
            return F.when(at < c("l"), c("lo")).when(between < F.size(c("m")), F.get(c("m"), between.cast("int"))).otherwise(c("hi"))

        low, high = value(F.floor(place)), value(F.ceil(place))
        part = place - F.floor(place)
        out.append(F.when(c("n") > 0, F.when(part == 0, low).otherwise((1 - part) * low + part * high)).alias(k))
    return found.select(*keys, *out, *beside)


def modes(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, columns): the most frequent value of each column, the smallest of equals, by counts of values."""
    out = df.select(*keys).distinct()
    for c in columns:
        n = df.where(F.col(c).isNotNull()).groupBy(*keys, c).agg(F.count(F.lit(1)).alias("__n"))
        best = n.groupBy(*keys).agg(F.min(F.struct((-F.col("__n")).alias("n"), F.col(c).alias("v"))).alias("__b"))
        out = out.join(best.select(*keys, F.col("__b.v").alias(c)), keys, "left")
    return out


def _weight(std: Column, method: str) -> Column:
    return F.try_divide(F.lit(1.0), std * std) if method == "weight" else F.lit(1.0)


def weighted(column: Column, std: Column, method: str = "weight") -> Column:
    """Mean by inverse variance, plain mean, or median of the rows where the column is finite."""
    h = finite(column)
    if method == "median":
        return F.median(h)
    w = F.when(h.isNotNull(), _weight(std, method))
    return F.try_divide(F.sum(w * h), F.sum(w))


def scaled_std(column: Column, std: Column, method: str = "weight") -> Column:
    """Weighted sample deviation over the root of the independent looks."""
    h = finite(column)
    w = F.when(h.isNotNull(), _weight(std, method))
    mean = F.try_divide(F.sum(w * h), F.sum(w))
    spread = F.greatest(F.try_divide(F.sum(w * h * h), F.sum(w)) - mean * mean, F.lit(0.0))
    looks = F.avg(F.when(h.isNotNull(), F.try_divide("eff_num_medium_looks", "eff_num_rare_looks")))
    return F.sqrt(spread) * F.sqrt(F.try_divide(looks, F.count(h)))


def multilook_uncertainty(derivative: str, height: Column, std: Column, method: str = "weight") -> Column:
    """Uncertainty from the object's coherence, for a derivative by phase: dheight, dlatitude or dlongitude.

    Null for an object without weights, looks or coherence, and where the derivatives cancel.
    """
    ok = finite(height).isNotNull()
    w = F.when(ok, _weight(std, method))
    total = F.sum(w)
    v = lambda c: F.try_divide(F.sum(w * c), total)
    vv = lambda c: F.sum(w * c)
    coherence = F.try_divide(F.sqrt(vv(F.col("ifg_re")) ** 2 + vv(F.col("ifg_im")) ** 2), F.sqrt(vv(F.col("power_plus_y")) * vv(F.col("power_minus_y"))))
    looks = F.avg(F.when(ok, F.col("eff_num_rare_looks"))) * F.count(F.when(ok, 1))
    variance = F.try_divide(F.try_divide(F.lit(0.5), looks) * (1 - coherence**2), coherence**2)
    d = F.col(f"{derivative}_dphase")
    mean = F.when(F.abs(v(d)) > CANCELS * v(F.abs(d)), v(d))
    return F.sqrt(F.when(variance.isNotNull(), F.greatest(variance, F.lit(TINY)))) * F.abs(F.try_divide(v(d * d), mean))


def height_aggregates(height: Column, std: Column, method: str = "weight") -> dict[str, Column]:
    """wse, its sample deviation, the deviation by looks and the three multilook uncertainties, for one ``agg``."""
    h = finite(height)
    return {
        "wse": weighted(height, std, method),
        "wse_std": F.stddev_pop(h),
        "wse_u": scaled_std(height, std, method),
        "wse_r_u": multilook_uncertainty("dheight", height, std, method),
        "lat_u": multilook_uncertainty("dlatitude", height, std, method),
        "lon_u": multilook_uncertainty("dlongitude", height, std, method),
    }


def area(klass: Column, method: str = "composite") -> Column:
    """Area in the pixels' unit: whole pixels, by water fraction, or whole inside and by fraction at edges."""
    a, wf = F.col("pixel_area"), F.col("water_frac")
    inside, edge = klass.isin(*INTERIOR, *DARK_CLASSES), klass.isin(*EDGES)
    if method == "simple":
        return F.sum(F.when(inside | edge, a))
    if method == "water_fraction":
        return F.sum(F.when(inside | edge, a * wf))
    return F.sum(F.when(inside, a).when(edge, a * wf))


def area_uncertainty(pixels: DataFrame, klass: Column, keys: list[str], scope: list[str] | None = None, method: str = "composite") -> DataFrame:
    """(keys, area_u): deviation of the area by the composite model's closed form.

    ``scope`` names the columns whose groups give the edge share and the bias sums: the tile by default,
    or the object's own keys. simple and water_fraction leave the other method's terms out.
    """
    scope = scope or ["tile_number"]
    a, sa = F.col("pixel_area"), F.col("darea_dheight") * DEM_STD * F.col("pixel_area")
    edge, inside = klass.isin(*EDGES), klass.isin(*INTERIOR)
    either = edge | inside
    pfa = pma = 1 - P_CORRECT
    pf, pmd, pfd = 0.5, F.col("missed_detection_rate"), F.col("false_detection_rate")
    u2, alpha = F.col("water_frac_uncert") ** 2, F.col("water_frac")
    bf, vf = pfa * (1 - P_TRUE_FRACTION) - pma * pf, 0.1
    pdw = (1 - pmd) * P_WATER + pfd * (1 - P_WATER)
    vdw = pfd * (1 - P_WATER) + pmd * P_WATER
    vdwf = pf * vdw + P_WATER * vf - 2 * pmd * P_WATER * pfa * (1 - P_TRUE_FRACTION)
    bdwf = (pfd * (1 - P_WATER) - pmd * P_WATER) * P_TRUE_FRACTION + P_WATER * bf
    va = u2 * pf + alpha * alpha * vf
    on = lambda cond, e: F.sum(F.when(cond, e).otherwise(0.0))
    wide = [*keys, *(c for c in scope if c not in keys)]
    plain, part = a * bdwf, a * alpha * bf
    # the bias of a pixel is a mixture of two terms by the edge share of its scope, so sums of their products are enough
    moments = {"m0": plain, "m1": part, "m00": plain * plain, "m01": plain * part, "m11": part * part, "ne": F.when(edge, 1.0).otherwise(0.0), "nb": F.lit(1.0)}
    per = pixels.groupBy(*wide).agg(
        on(edge, a * a / 12 * P_TRUE_FRACTION).alias("v0"),
        on(either, sa * sa * pdw * pf).alias("v1"),
        on(either, a * a * vdwf).alias("v2"),
        on(either, a * a * va).alias("v3"),
        on(either, sa * sa * (u2 + alpha * alpha) * pf).alias("v4"),
        *(on(either, e).alias(k) for k, e in moments.items()),
    )
    whole = per.groupBy(*scope).agg(*(F.sum(k).alias(k) for k in moments))
    pde = F.coalesce(F.least(F.lit(1.0), F.try_divide("ne", "nb")), F.lit(0.0))
    q = 1 - F.col("pde")
    bias = (q * F.col("m0") + F.col("pde") * F.col("m1")) ** 2 - (q * q * F.col("m00") + 2 * q * F.col("pde") * F.col("m01") + F.col("pde") ** 2 * F.col("m11"))
    whole = whole.withColumn("pde", pde).select(*scope, "pde", bias.alias("bias"))
    terms = per.drop(*moments).join(whole, scope)
    s = {k: F.sum(k) for k in ("v0", "v1", "v2", "v3", "v4")}
    pde, b = F.max("pde"), F.max("bias")
    if method == "simple":
        total = 0.1 * s["v0"] + s["v2"] + s["v1"] + b
    elif method == "water_fraction":
        total = 0.1 * s["v0"] + s["v3"] + s["v4"]
    else:
        total = 0.1 * s["v0"] + pde * s["v3"] + (1 - pde) * s["v2"] + pde * s["v4"] + (1 - pde) * s["v1"] + b
    return terms.groupBy(*keys).agg(F.sqrt(F.greatest(total, F.lit(0.0))).alias("area_u"))


def areas(pixels: DataFrame, keys: list[str], scope: list[str] | None = None, method: str = "composite") -> DataFrame:
    """(keys, area_total, area_tot_u, area_detct, area_det_u, percent_det, dark_frac), areas in km2."""
    total, detected = F.col("as_full_water"), F.col("without_dw")
    both = pixels.groupBy(*keys).agg((area(total, method) / 1e6).alias("area_total"), (area(detected, method) / 1e6).alias("area_detct"))
    tu = area_uncertainty(pixels, total, keys, scope, method).withColumnRenamed("area_u", "tu")
    du = area_uncertainty(pixels, detected, keys, scope, method).withColumnRenamed("area_u", "du")
    out = both.join(tu, keys).join(du, keys)
    return out.select(
        *keys,
        "area_total",
        (F.col("tu") / 1e6).alias("area_tot_u"),
        F.coalesce("area_detct", F.lit(0.0)).alias("area_detct"),
        (F.col("du") / 1e6).alias("area_det_u"),
        F.try_divide(F.coalesce("area_detct", F.lit(0.0)), F.col("area_total")).alias("percent_det"),
        dark_fraction(F.coalesce("area_detct", F.lit(0.0)), F.col("area_total")).alias("dark_frac"),
    )


def dark_fraction(detected: Column, total: Column) -> Column:
    return 1 - F.try_divide(detected, total)


def backscatter(kind: str = "rare") -> dict[str, Column]:
    """Mean, deviation and uncertainty of sig0; the uncertainty from rare or medium looks."""
    s = finite(F.col("sig0"))
    looks = F.col("eff_num_rare_looks" if kind == "rare" else "eff_num_medium_looks")
    return {"sig0": F.avg(s), "sig0_std": F.stddev_pop(s), "sig0_u": F.try_divide(F.sqrt(F.sum(F.try_divide(s * s, looks))), F.count(s))}


def two_sigma(df: DataFrame, keys: list[str], columns: list[str], how: str = "mean") -> DataFrame:
    """Mean or deviation of each column over the rows within two deviations of the median, in one pass of rejection."""
    clean = df.select(*keys, *(finite(F.col(c)).alias(c) for c in columns))
    middle = percentiles(clean, keys, {f"__m_{c}": (c, 0.5) for c in columns}, {f"__s_{c}": F.stddev_pop(c) for c in columns})
    kept = lambda c: F.when(F.abs(F.col(c) - F.col(f"__m_{c}")) <= 2 * F.col(f"__s_{c}"), F.col(c))
    out = F.avg if how == "mean" else F.stddev_pop
    return clean.join(middle, keys).groupBy(*keys).agg(*(out(kept(c)).alias(c) for c in columns))


def nominal_share() -> Column:
    """Share of pixels whose class and geolocation flags are both clean."""
    return F.avg((F.col("classification_qual") * F.col("geolocation_qual") == 0).cast("double"))


def quality_flag(threshold: float = 0.5) -> Column:
    return (nominal_share() < threshold).cast("int")


def crossover_quality(flag: str = "geolocation_qual") -> Column:
    """2 if any pixel has bit 23, else 1 if any has bit 6, else 0."""
    bit = lambda n: F.col(flag).bitwiseAND(F.lit(1 << n)) != 0
    return F.max(F.when(bit(23), 2).when(bit(6), 1).otherwise(0))


CORRECTIONS = {
    "geoid_hght": "geoid",
    "solid_tide": "solid_earth_tide",
    "load_tidef": "load_tide_fes",
    "load_tideg": "load_tide_got",
    "pole_tide": "pole_tide",
    "dry_trop_c": "model_dry_tropo_cor",
    "wet_trop_c": "model_wet_tropo_cor",
    "iono_c": "iono_cor_gim_ka",
    "xovr_cal_c": "height_cor_xover",
}


def mean_time(t: Column) -> Column:
    """Mean of times in seconds, added up exactly in microseconds: a sum of doubles of this size depends on the order of rows."""
    return F.sum(t.cast("decimal(20,6)")).cast("double") / F.nullif(F.count(t), F.lit(0))


def lake_attributes(pixels: DataFrame, keys: list[str], height: Column, std: Column, nominal: float = 0.5, scope: list[str] | None = None) -> DataFrame:
    """The common attributes of each object; ``pixels`` has the role columns of :func:`mereflow.operators.select.with_roles`.

    Time, quality and corrections use all pixels, wse its own role, spread and layover the interior.
    """
    wse = F.when(F.col("is_for_wse"), height)
    inside = F.col("is_interior")
    own = {k: v for k, v in height_aggregates(wse, std).items() if k in ("wse", "wse_u", "wse_r_u")}
    own |= {
        "time": mean_time(finite(F.col("illumination_time"))),
        "wse_std": F.stddev_pop(F.when(inside, finite(height))),
        "layovr_val": F.avg(F.when(inside, finite(F.col("layover_impact")))),
        "xtrk_dist": F.avg(finite(F.col("cross_track"))),
        "quality_f": quality_flag(nominal),
        "xovr_cal_q": crossover_quality(),
        "n_pix": F.count(F.lit(1)),
    }
    base = pixels.groupBy(*keys).agg(*(v.alias(k) for k, v in own.items()))
    fixes = two_sigma(pixels.select(*keys, *(F.col(c).alias(k) for k, c in CORRECTIONS.items())), keys, list(CORRECTIONS))
    return base.join(areas(pixels, keys, scope), keys).join(fixes, keys)


def geophysical_reference(columns: dict[str, str], std: Column) -> dict[str, Column]:
    """Heights' weights applied to other columns: {name: column} to {name: aggregate}."""
    return {k: weighted(F.col(c), std) for k, c in columns.items()}


def object_sizes(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, size_km2, interior_km2, n_pix)."""
    inside = F.col("classification").isin(*INTERIOR)
    return pixels.groupBy(*keys).agg((F.sum("pixel_area") / 1e6).alias("size_km2"), (F.coalesce(F.sum(F.when(inside, F.col("pixel_area"))), F.lit(0.0)) / 1e6).alias("interior_km2"), F.count(F.lit(1)).alias("n_pix"))


def fuse_duplicates(lakes: DataFrame, keys: list[str], ratio: list[str], total: list[str], largest: list[str], lists: dict[str, str], area_col: str = "area_total") -> DataFrame:
    """One row per lake: ratio columns are area-weighted means, total columns sums, largest columns maxima.

    ``lists`` maps id columns to the overlap column that orders them. Rows without an area leave
    their values to the others; a null value of a row with an area makes the fused value null.
    """
    a = F.col(area_col)

    def mean(c):
        known = F.sum(F.when(F.col(c).isNull() & a.isNotNull(), 1).otherwise(0)) == 0
        fused = F.try_divide(F.sum(F.when(a.isNotNull(), F.col(c) * a)), F.sum(a))
        return F.when(F.count(a) == 0, F.avg(c)).when(known, fused).alias(c)

    def add(c):
        known = F.sum(F.when(F.col(c).isNull() & a.isNotNull(), 1).otherwise(0)) == 0
        return F.when(F.count(a) == 0, F.sum(c)).when(known, F.sum(F.when(a.isNotNull(), F.col(c)))).alias(c)

    by_overlap = lambda c, o: F.transform(F.sort_array(F.collect_list(F.struct((-F.col(o)).alias("o"), F.col(c).alias("v")))), lambda s: s["v"])
    out = [*(mean(c) for c in ratio), *(add(c) for c in total if c != area_col), F.sum(a).alias(area_col), *(F.max(c).alias(c) for c in largest), *(F.array_join(by_overlap(c, o), ";").alias(c) for c, o in lists.items())]
    return lakes.groupBy(*keys).agg(*out)


def compare_totals(observed: DataFrame, prior: DataFrame, columns: list[str], alert: float = 0.1) -> DataFrame:
    """A row per column with both totals and whether they differ by more than ``alert`` of the observed one."""
    one = lambda df, name: df.agg(*(F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in columns)).select(F.stack(F.lit(len(columns)), *(x for c in columns for x in (F.lit(c), F.col(c)))).alias("attribute", name))
    both = one(observed, "observed").join(one(prior, "prior"), "attribute")
    return both.withColumn("alert", F.abs(F.col("observed") - F.col("prior")) > alert * F.abs(F.col("observed")))


def majority_tile(pixels: DataFrame, keys: list[str], tile: str = "tile_number") -> DataFrame:
    """(keys, tile) with most pixels of each object, the smallest of equals."""
    n = pixels.groupBy(*keys, tile).agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(*keys).agg(F.max_by(tile, F.struct("n", -F.col(tile))).alias(tile))


def extent(points: DataFrame, keys: list[str], x: str = "longitude", y: str = "latitude") -> DataFrame:
    return points.groupBy(*keys).agg(F.min(x).alias("x_min"), F.max(x).alias("x_max"), F.min(y).alias("y_min"), F.max(y).alias("y_max"))


def reach_fit(nodes: DataFrame, least: float = -2000.0) -> DataFrame:
    """(reach_id, slope, intercept) of node height on node id, for reaches of two good nodes or more."""
    good = nodes.where(finite(F.col("h_n_ave")) >= least)
    n = good.groupBy("reach_id").agg(F.regr_slope("h_n_ave", "node_id").alias("slope"), F.regr_intercept("h_n_ave", "node_id").alias("intercept"), F.count(F.lit(1)).alias("n"))
    return n.where("n >= 2").select("reach_id", "slope", "intercept")
