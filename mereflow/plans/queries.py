"""Queries over the derived tables, one or more per operator, each with the same rows in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mereflow import fixtures as X
from mereflow.functions import scalars as S
from mereflow.operators import aggregates as A
from mereflow.operators import select as P

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
KEY = ("tile_number", "range_index", "azimuth_index")
LAKE = ["tile_number", "lake"]


def query(sql: str | None = None, name: str | None = None):
    """Register a query with its SQL; ``{pixc}`` and the like in it stand for the derived tables' CTEs."""

    def put(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql is not None:
            ORACLE[key] = sql.replace("{pixc}", X.PIXC_SQL).replace("{lakesp}", X.LAKESP_SQL).replace("{pld}", X.PLD_SQL).replace("{poly}", X.POLY_SQL)
        return f

    return put


def r6(df: DataFrame, *keep: str, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that sums in another order agree."""
    return df.select(*(F.round(c, digits).alias(c) if t == "double" and c not in keep else F.col(c) for c, t in df.dtypes))


def load(f):
    """Call ``f(pixels)`` with the derived pixel cloud."""
    return lambda spark, sf_dir: f(X.pixc(spark, sf_dir))


NULLED = "case when isnan({0}) or isinf({0}) then null else {0} end"


def n(c: str) -> str:
    return NULLED.format(c)


# Selection ------------------------------------------------------------------------------------

KEYS = ", ".join(KEY)


@query(f"with {{pixc}} select {KEYS} from pixc where not (river=1 and right(reach_id,1)<>'3')")
def f1_reject_river(spark, sf_dir):
    p = X.pixc(spark, sf_dir)
    return P.reject_river(p, p.where("river = 1")).select(*KEY)


@query(f"with {{pixc}} select {KEYS} from pixc where not isnan(height) and classification<=10 and range_index<=999999 and azimuth_index<=999999")
def f2_located(spark, sf_dir):
    return P.located(X.pixc(spark, sf_dir)).select(*KEY)


@query(f"with {{pixc}} select {KEYS} from pixc where geolocation_qual&64=0 and interferogram_qual&5=0 and classification_qual=0")
def f3_clean_flags(spark, sf_dir):
    return P.clean_flags(X.pixc(spark, sf_dir), {"geolocation_qual": 64, "interferogram_qual": 5, "classification_qual": 0}).select(*KEY)


@query(f"with {{pixc}} select {KEYS} from pixc where classification in (2,3,4,5) and bright_land_flag=0")
def f4_classes(spark, sf_dir):
    return P.of_classes(X.pixc(spark, sf_dir), (2, 3, 4, 5), bright_land=False).select(*KEY)


@query(f"""with {{pixc}} select {KEYS}, classification in (3,4,6,7) as is_water, classification=5 as is_dark, classification in (4,5) as is_interior,
  classification in (2,3,4,5,6,7) as is_for_hull, classification in (3,4,6,7) as is_for_wse, classification in (2,3,4,5,6,7) as is_for_area,
  case when classification in (2,3) then 3 else 4 end as as_full_water, case when classification=5 then 0 else classification end as without_dw from pixc""")
def f5_roles(spark, sf_dir):
    new = ["is_water", "is_dark", "is_interior", "is_for_hull", "is_for_wse", "is_for_area", "as_full_water", "without_dw"]
    return P.with_roles(X.pixc(spark, sf_dir)).select(*KEY, *new)


@query(f"""with {{pixc}} select {KEYS}, round(case when classification in (2,3) then pixel_area*water_frac else pixel_area end,6) as inundated_area,
  round(case when phase_noise_std>0 then abs(phase_noise_std*dheight_dphase) else 1e5 end,6) as height_std_pix,
  round({n("height")}-{n("geoid")}-{n("solid_earth_tide")}-{n("pole_tide")}-{n("load_tide_fes")},6) as corrected_height from pixc""")
def f6_f7_f8_derived(spark, sf_dir):
    p = X.pixc(spark, sf_dir)
    return r6(p.select(*KEY, P.inundated_area().alias("inundated_area"), P.phase_height_std().alias("height_std_pix"), P.corrected_height().alias("corrected_height")))


@query(f"""with {{pixc}}, w as (select *, max(case when cross_track between 20000 and 60000 then 0 else 1 end) over (partition by tile_number, lake) as partial_f from pixc)
  select {KEYS}, partial_f from w where cross_track between 20000 and 60000""")
def f9_cross_track_window(spark, sf_dir):
    return P.cross_track_window(X.pixc(spark, sf_dir), LAKE, 20000.0, 60000.0).select(*KEY, "partial_f")


@query(f"with {{pixc}} select {KEYS}, max(case when range_index in (0,95) then 1 else 0 end) over (partition by tile_number, lake) as partial_f from pixc")
def f9_border_columns(spark, sf_dir):
    return P.cross_track_window(X.pixc(spark, sf_dir), LAKE, None, None, 96).select(*KEY, "partial_f")


@query(f"""with {{pixc}}, w as (select *, {n("height")} is not null and {n("pole_tide")} is not null as good from pixc),
  v as (select *, min(case when good then 1 else 0 end) over (partition by tile_number, lake)+1 as validity from w)
  select {KEYS}, validity from v where good""")
def f10_valid_geolocation(spark, sf_dir):
    return P.valid_geolocation(X.pixc(spark, sf_dir), LAKE, ("height", "pole_tide")).select(*KEY, "validity")


@query("""with {pixc} select tile_number, lake, round(sum(case when classification in (4,5) then pixel_area end)/1e6,9) as size_km2 from pixc group by 1,2
  having sum(case when classification in (4,5) then pixel_area end)/1e6>=0.004 and count(distinct range_index)>1 and count(distinct azimuth_index)>1""")
def f11_large_objects(spark, sf_dir):
    return r6(P.large_objects(X.pixc(spark, sf_dir), LAKE, 0.004, F.col("classification").isin(4, 5)), digits=9)


@query(f"with {{pixc}} select {KEYS} from pixc where classification in (3,4,5,6,7)")
def f12_water_points(spark, sf_dir):
    return P.of_classes(X.pixc(spark, sf_dir), (3, 4, 5, 6, 7)).select(*KEY)


@query("""with {pixc}, l as (select tile_number, azimuth_index, min(case when cross_track>=30000 then range_index end) as first_kept, max(case when cross_track<30000 then range_index end) as last_removed from pixc group by 1,2)
  select *, coalesce(first_kept=last_removed+1,false) as adjacent from l""")
def f13_w8_near_range(spark, sf_dir):
    return P.near_range_border(X.pixc(spark, sf_dir), 30000.0)


@query(f"""with {{pixc}}, l as (select tile_number, azimuth_index, min(case when cross_track>=30000 then range_index end) as fk, max(case when cross_track<30000 then range_index end) as lr from pixc group by 1,2),
  m as (select tile_number, max(azimuth_index) as am, max(range_index) as rm from pixc group by 1)
  select p.tile_number, p.range_index, p.azimuth_index from pixc p join l using (tile_number, azimuth_index) join m using (tile_number)
  where cross_track>=30000 and azimuth_index not in (0,am) and range_index<>rm and not (coalesce(fk=lr+1,false) and range_index=fk)""")
def f14_remove_borders(spark, sf_dir):
    return P.remove_borders(X.pixc(spark, sf_dir), 30000.0).select(*KEY)


@query(f"with {{pixc}} select {KEYS} from pixc where longitude between 0.012 and 0.05 and latitude between 45.012 and 45.05")
def f15_box(spark, sf_dir):
    return P.in_box(X.pixc(spark, sf_dir), 0.012, 0.05, 45.012, 45.05).select(*KEY)


@query("""with {lakesp}, s as (select *, max(case when obs_id<>'no_data' then 1 else 0 end) over (partition by lake_id, cycle_number) as seen from lakesp),
  k as (select lake_id, cycle_number, min(pass_number) as pass_number from s where seen=0 group by 1,2)
  select lake_id, cycle_number, pass_number, obs_id from s where obs_id<>'no_data' union all select lake_id, cycle_number, pass_number, 'no_data' from k""")
def f16_observed_first(spark, sf_dir):
    cols = ["lake_id", "cycle_number", "pass_number", "obs_id"]
    return P.observed_first(X.lakesp(spark, sf_dir).select(*cols), ["lake_id", "cycle_number"])


@query(f"with {{pixc}} select {KEYS}, {n('height')} as value, coalesce({n('pole_tide')}, height) as uncertainty from pixc where {n('height')} is not null")
def f17_storage_inputs(spark, sf_dir):
    p = X.pixc(spark, sf_dir).withColumns({"value": P.storage_input(F.col("height")), "uncertainty": P.storage_uncertainty(F.col("pole_tide"), F.col("height"))})
    return p.where("value is not null").select(*KEY, "value", "uncertainty")


@query("""with {pld} select lake_id, case when ref_wse>=0 then ref_wse end as ref_wse, case when ref_area>=0 then ref_area end as ref_area,
  case when ds_t0>=-9e7 then ds_t0 end as ds_t0, case when res_id>=0 then res_id end as res_id from pld""")
def f18_prior_sentinels(spark, sf_dir):
    return P.normalise_prior(X.pld(spark, sf_dir)).select("lake_id", "ref_wse", "ref_area", "ds_t0", "res_id")


@query("with {pld} select lake_id from pld where starts_with(lake_id,'10000000') and list_contains(string_split(concat('a;', right(lake_id,1)),';'),'3')")
def f19_id_predicates(spark, sf_dir):
    p = X.pld(spark, sf_dir).withColumn("list", F.concat(F.lit("a;"), F.substring("lake_id", -1, 1)))
    return p.where(P.id_predicate("lake_id", prefix="10000000") & P.id_predicate("list", listed="3")).select("lake_id")


# Aggregates -----------------------------------------------------------------------------------


@query(f"""with {{pixc}}, c as (select tile_number, lake, {n("height")} as h, classification from pixc)
  select tile_number, lake, round(avg(h),9) as mean, round(median(h),9) as median, round(sum(h),6) as sum, round(stddev_pop(h),9) as std,
  round(quantile_cont(h,0.9),9) as percentile, count(classification) as count, min(mc) as mode from c join
  (select tile_number, lake, arg_min(classification, struct_pack(a:=-k, b:=classification)) as mc from (select tile_number, lake, classification, count(*) as k from c group by 1,2,3) group by 1,2) using (tile_number, lake) group by 1,2""")
def a1_metrics(spark, sf_dir):
    p = X.pixc(spark, sf_dir).withColumn("h", F.nanvl("height", F.lit(None).cast("double")))
    plain = p.groupBy(*LAKE).agg(*(F.round(A.metric("h", k), 6 if k == "sum" else 9).alias(k) for k in ("mean", "sum", "std")), A.metric("classification", "count").alias("count"))
    ranked = A.percentiles(p, LAKE, {"median": ("h", 0.5), "percentile": ("h", 0.9)})
    return r6(plain.join(ranked, LAKE).join(A.modes(p, LAKE, ["classification"]).withColumnRenamed("classification", "mode"), LAKE), digits=9)


W = "1/(height_std*height_std)"
HEIGHT_SQL = f"""with {{pixc}}, c as (select *, {n("height")} as h, {W} as w from pixc), m as (
  select tile_number, lake, sum(w*h)/sum(w) as wse, count(*) as k, sum(w) as sw, avg(eff_num_rare_looks)*count(*) as looks, avg(eff_num_medium_looks/eff_num_rare_looks) as ratio,
    sqrt(pow(sum(w*ifg_re),2)+pow(sum(w*ifg_im),2))/sqrt(sum(w*power_plus_y)*sum(w*power_minus_y)) as coh,
    sum(w*dheight_dphase*dheight_dphase)/case when abs(sum(w*dheight_dphase))>1e-12*sum(w*abs(dheight_dphase)) then sum(w*dheight_dphase) end as vh, sum(w*dlatitude_dphase*dlatitude_dphase)/sum(w*dlatitude_dphase) as vla, sum(w*dlongitude_dphase*dlongitude_dphase)/sum(w*dlongitude_dphase) as vlo,
    stddev_pop(h) as wse_std
  from c where h is not null group by 1,2),
  s as (select c.tile_number, c.lake, sum(w*pow(h-wse,2))/sum(w) as spread from c join m using (tile_number, lake) where h is not null group by 1,2)"""


@query(f"""{HEIGHT_SQL} select tile_number, lake, round(wse,6) as wse, round(wse_std,6) as wse_std, round(sqrt(spread)*sqrt(ratio/k),6) as wse_u,
  round(sqrt(greatest(0.5/looks*(1-coh*coh)/(coh*coh),2.22e-16))*abs(vh),5) as wse_r_u,
  round(sqrt(greatest(0.5/looks*(1-coh*coh)/(coh*coh),2.22e-16))*abs(vla),12) as lat_u, round(sqrt(greatest(0.5/looks*(1-coh*coh)/(coh*coh),2.22e-16))*abs(vlo),12) as lon_u
  from m join s using (tile_number, lake)""")
def a2_a5_height(spark, sf_dir):
    out = X.pixc(spark, sf_dir).groupBy(*LAKE).agg(*(v.alias(k) for k, v in A.height_aggregates(F.col("height"), F.col("height_std")).items()), F.count(S.finite(F.col("height"))).alias("k"))
    out = out.where("k > 0").drop("k")
    return out.select(*LAKE, *(F.round(c, 6).alias(c) for c in ("wse", "wse_std", "wse_u")), F.round("wse_r_u", 5).alias("wse_r_u"), F.round("lat_u", 12).alias("lat_u"), F.round("lon_u", 12).alias("lon_u"))


@query("""with {pixc} select tile_number, lake, round(sum(case when classification in (2,3,4,5,6,7) then pixel_area end),6) as simple,
  round(sum(case when classification in (2,3,4,5,6,7) then pixel_area*water_frac end),6) as fraction,
  round(sum(case when classification in (4,5,6,7) then pixel_area when classification in (2,3) then pixel_area*water_frac end),6) as composite from pixc group by 1,2""")
def a6_area(spark, sf_dir):
    k = F.col("classification")
    return r6(X.pixc(spark, sf_dir).groupBy(*LAKE).agg(*(A.area(k, m).alias(a) for a, m in (("simple", "simple"), ("fraction", "water_fraction"), ("composite", "composite")))))


def _area_sql(scope: str) -> str:
    return f"""with {{pixc}}, c as (select *, classification in (2,3) as e, classification in (2,3,4,6,7) as i, darea_dheight*10*pixel_area as sa from pixc),
  d as (select *, least(1.0, sum(case when e then 1.0 else 0 end) over w / sum(case when i then 1.0 else 0 end) over w) as pde0 from c window w as (partition by {scope})),
  q as (select *, coalesce(pde0,0) as pde, 0.1*(1-0.5)-0.1*0.5 as bf from d),
  b as (select *, case when i then pixel_area*((1-pde)*((false_detection_rate*0.5-missed_detection_rate*0.5)*0.5+0.5*bf)+pde*water_frac*bf) end as bias from q),
  t as (select *, sum(bias) over w as b1, sum(bias*bias) over w as b2 from b window w as (partition by {scope})),
  s as (select tile_number, lake, max(pde) as pde, max(coalesce(b1*b1-b2,0)) as bb,
    sum(case when e then pixel_area*pixel_area/12*0.5 else 0 end) as v0,
    sum(case when i then sa*sa*((1-missed_detection_rate)*0.5+false_detection_rate*0.5)*0.5 else 0 end) as v1,
    sum(case when i then pixel_area*pixel_area*(0.5*(false_detection_rate*0.5+missed_detection_rate*0.5)+0.5*0.1-2*missed_detection_rate*0.5*0.1*0.5) else 0 end) as v2,
    sum(case when i then pixel_area*pixel_area*(water_frac_uncert*water_frac_uncert*0.5+water_frac*water_frac*0.1) else 0 end) as v3,
    sum(case when i then sa*sa*(water_frac_uncert*water_frac_uncert+water_frac*water_frac)*0.5 else 0 end) as v4
    from t group by 1,2)
  select tile_number, lake, round(sqrt(greatest(0.1*v0+pde*v3+(1-pde)*v2+pde*v4+(1-pde)*v1+bb,0)),3) as area_u from s"""


@query(_area_sql("tile_number"))
def a7_area_uncertainty_tile(spark, sf_dir):
    return r6(A.area_uncertainty(X.pixc(spark, sf_dir), F.col("classification"), LAKE), digits=3)


@query(_area_sql("tile_number, lake"))
def a7_area_uncertainty_lake(spark, sf_dir):
    return r6(A.area_uncertainty(X.pixc(spark, sf_dir), F.col("classification"), LAKE, LAKE), digits=3)


@query("""with {pixc}, s as (select tile_number, lake, sum(case when classification in (2,3) then pixel_area*water_frac else pixel_area end)/1e6 as t,
  coalesce(sum(case when classification in (2,3) then pixel_area*water_frac when classification in (4,6,7) then pixel_area end)/1e6,0) as d from pixc group by 1,2)
  select tile_number, lake, round(t,9) as area_total, round(d,9) as area_detct, round(d/t,9) as percent_det, round(1-d/t,9) as dark_frac from s""")
def a8_a14_areas(spark, sf_dir):
    return r6(A.areas(P.with_roles(X.pixc(spark, sf_dir)), LAKE).drop("area_tot_u", "area_det_u"), digits=9)


@query("""with {pixc} select tile_number, lake, round(avg(sig0),6) as sig0, round(stddev_pop(sig0),6) as sig0_std, round(sqrt(sum(sig0*sig0/eff_num_rare_looks))/count(sig0),6) as sig0_u from pixc group by 1,2""")
def a9_backscatter(spark, sf_dir):
    return r6(X.pixc(spark, sf_dir).groupBy(*LAKE).agg(*(v.alias(k) for k, v in A.backscatter().items())))


def _two_sigma_sql(f: str) -> str:
    return f"""with {{pixc}}, c as (select tile_number, lake, {n("height")} as h, cross_track as x from pixc),
  m as (select tile_number, lake, median(h) as mh, stddev_pop(h) as sh, median(x) as mx, stddev_pop(x) as sx from c group by 1,2)
  select tile_number, lake, round({f}(case when abs(h-mh)<=2*sh then h end),6) as height, round({f}(case when abs(x-mx)<=2*sx then x end),5) as cross_track from c join m using (tile_number, lake) group by 1,2"""


@query(_two_sigma_sql("avg"))
def a10_mean_two_sigma(spark, sf_dir):
    return A.two_sigma(X.pixc(spark, sf_dir), LAKE, ["height", "cross_track"]).select(*LAKE, F.round("height", 6).alias("height"), F.round("cross_track", 5).alias("cross_track"))


@query(_two_sigma_sql("stddev_pop"))
def a11_std_two_sigma(spark, sf_dir):
    return A.two_sigma(X.pixc(spark, sf_dir), LAKE, ["height", "cross_track"], "std").select(*LAKE, F.round("height", 6).alias("height"), F.round("cross_track", 5).alias("cross_track"))


_A12 = ["wse", "wse_u", "time", "wse_std", "layovr_val", "xtrk_dist", "quality_f", "xovr_cal_q", "n_pix", "area_total", "area_detct", "dark_frac", "geoid_hght", "solid_tide", "dry_trop_c"]


@query(f"""with {{pixc}}, c as (select *, {n("height")} as h, {W} as w, classification in (3,4,6,7) as isw, classification in (4,5) as isi from pixc),
  m as (select tile_number, lake, sum(case when isw and h is not null then w*h end)/sum(case when isw and h is not null then w end) as wse from c group by 1,2),
  g as (select tile_number, lake, median(geoid) as mg, stddev_pop(geoid) as sg, median(solid_earth_tide) as ms, stddev_pop(solid_earth_tide) as ss, median(model_dry_tropo_cor) as md, stddev_pop(model_dry_tropo_cor) as sd from c group by 1,2)
  select c.tile_number, c.lake, round(max(wse),8) as wse,
   round(sqrt(sum(case when isw and h is not null then w*pow(h-wse,2) end)/sum(case when isw and h is not null then w end))*sqrt(avg(case when isw and h is not null then eff_num_medium_looks/eff_num_rare_looks end)/count(case when isw then h end)),8) as wse_u,
   round(avg(illumination_time),4) as time, round(stddev_pop(case when isi then h end),8) as wse_std, round(avg(case when isi then layover_impact end),8) as layovr_val, round(avg(cross_track),8) as xtrk_dist,
   cast(avg(case when classification_qual*geolocation_qual=0 then 1.0 else 0 end)<0.5 as int) as quality_f,
   max(case when geolocation_qual&8388608<>0 then 2 when geolocation_qual&64<>0 then 1 else 0 end) as xovr_cal_q, count(*) as n_pix,
   round(sum(case when classification in (2,3) then pixel_area*water_frac else pixel_area end)/1e6,8) as area_total,
   round(coalesce(sum(case when classification in (2,3) then pixel_area*water_frac when classification in (4,6,7) then pixel_area end),0)/1e6,8) as area_detct,
   round(1-coalesce(sum(case when classification in (2,3) then pixel_area*water_frac when classification in (4,6,7) then pixel_area end),0)/sum(case when classification in (2,3) then pixel_area*water_frac else pixel_area end),8) as dark_frac,
   round(avg(case when abs(geoid-mg)<=2*sg then geoid end),8) as geoid_hght, round(avg(case when abs(solid_earth_tide-ms)<=2*ss then solid_earth_tide end),8) as solid_tide, round(avg(case when abs(model_dry_tropo_cor-md)<=2*sd then model_dry_tropo_cor end),8) as dry_trop_c
  from c join m using (tile_number, lake) join g using (tile_number, lake) group by 1,2""")
def a12_lake_attributes(spark, sf_dir):
    return r6(A.lake_attributes(P.with_roles(X.pixc(spark, sf_dir)), LAKE, F.col("height"), F.col("height_std")).select(*LAKE, *_A12).withColumn("time", F.round("time", 4)), digits=8)


@query("""with {pixc} select tile_number, lake, round(avg(case when classification_qual*geolocation_qual=0 then 1.0 else 0 end),9) as nominal,
  max(case when geolocation_qual&8388608<>0 then 2 when geolocation_qual&64<>0 then 1 else 0 end) as xovr_cal_q from pixc group by 1,2""")
def a13_a15_quality(spark, sf_dir):
    return r6(X.pixc(spark, sf_dir).groupBy(*LAKE).agg(A.nominal_share().alias("nominal"), A.crossover_quality().alias("xovr_cal_q")), digits=9)


@query(f"with {{pixc}} select tile_number, lake, round(sum({W}*geoid)/sum({W}),6) as geoid_hght, round(sum({W}*load_tide_got)/sum({W}),6) as load_tideg from pixc group by 1,2")
def a16_geophysical_reference(spark, sf_dir):
    return r6(X.pixc(spark, sf_dir).groupBy(*LAKE).agg(*(v.alias(k) for k, v in A.geophysical_reference({"geoid_hght": "geoid", "load_tideg": "load_tide_got"}, F.col("height_std")).items())))


@query("""with {pixc} select tile_number, lake, round(sum(pixel_area)/1e6,9) as size_km2, round(coalesce(sum(case when classification in (4,6,7) then pixel_area end),0)/1e6,9) as interior_km2, count(*) as n_pix from pixc group by 1,2""")
def a17_sizes(spark, sf_dir):
    return r6(A.object_sizes(X.pixc(spark, sf_dir), LAKE), digits=9)


@query("""with {lakesp}, l as (select *, case when quality_f=2 then null else wse end as wse2 from lakesp)
  select lake_id, cycle_number, round(case when count(case when wse2 is null then 1 end)=0 then sum(wse2*area_total)/sum(area_total) end,8) as wse2, round(sum(geoid_hght*area_total)/sum(area_total),8) as geoid_hght,
  cast(sum(n) as bigint) as n, round(sum(area_total),6) as area_total, max(quality_f) as quality_f, max(partial_f) as partial_f, string_agg(obs_id, ';' order by -area_total, obs_id) as obs_id from l group by 1,2""")
def a18_fuse_duplicates(spark, sf_dir):
    own = X.lakesp(spark, sf_dir).withColumn("wse2", F.when(F.col("quality_f") != 2, F.col("wse")))
    return r6(A.fuse_duplicates(own, ["lake_id", "cycle_number"], ["wse2", "geoid_hght"], ["n"], ["quality_f", "partial_f"], {"obs_id": "area_total"}).withColumn("area_total", F.round("area_total", 6)), digits=8)


@query("""with {lakesp}, o as (select sum(area_total) as a, sum(dark_frac) as d from lakesp where quality_f<2), p as (select sum(area_total) as a, sum(dark_frac) as d from lakesp)
  select 'area_total' as attribute, round(o.a,4) as observed, round(p.a,4) as prior, abs(o.a-p.a)>0.1*abs(o.a) as alert from o, p
  union all select 'dark_frac', round(o.d,4), round(p.d,4), abs(o.d-p.d)>0.1*abs(o.d) from o, p""")
def a19_compare_totals(spark, sf_dir):
    own = X.lakesp(spark, sf_dir)
    return r6(A.compare_totals(own.where("quality_f < 2"), own, ["area_total", "dark_frac"]), digits=4)


@query("""with {pixc}, c as (select lake, tile_number, count(*) as k from pixc group by 1,2)
  select lake, tile_number from (select *, row_number() over (partition by lake order by k desc, tile_number) as r from c) where r=1""")
def a26_majority_tile(spark, sf_dir):
    return A.majority_tile(X.pixc(spark, sf_dir), ["lake"])


@query("with {pixc} select tile_number, min(longitude) as x_min, max(longitude) as x_max, min(latitude) as y_min, max(latitude) as y_max from pixc group by 1")
def a31_extent(spark, sf_dir):
    return A.extent(X.pixc(spark, sf_dir), ["tile_number"])


@query("""with {pixc}, g as (select reach_id, regr_slope(height, node_id) as s, regr_intercept(height, node_id) as i, count(*) as k from pixc where not isnan(height) group by 1)
  select reach_id, round(s,6) as slope, round(i,6) as intercept from g where k>=2""")
def a27_reach_fit(spark, sf_dir):
    return r6(A.reach_fit(X.pixc(spark, sf_dir).withColumnRenamed("height", "h_n_ave")))
