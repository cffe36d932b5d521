"""Queries of the cycle product, scalar functions, windows, products and label graphs."""

from __future__ import annotations

from pyspark.sql import functions as F

from mereflow import fixtures as X
from mereflow.functions import scalars as S
from mereflow.operators import cycle as C
from mereflow.operators import geometry as G
from mereflow.plans.queries import KEY, KEYS, r6

QUERIES: dict = {}
ORACLE: dict = {}


def query(sql=None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql.replace("{pixc}", X.PIXC_SQL).replace("{lakesp}", X.LAKESP_SQL).replace("{lakesp_part}", X.LAKESP_PART_SQL).replace("{pld}", X.PLD_SQL)
        return f

    return put

FIRST = """f as (select * from (select *, row_number() over (partition by cycle_number, lake_id, pass_number order by wse, area_total, wse_u, area_tot_u, geoid_hght, time, partial_f, quality_f, dark_frac, obs_id, n) as r from lakesp) where r=1)"""


@query("with {lakesp}, " + FIRST + " select lake_id, cycle_number, pass_number, wse, area_total from f")
def a20_archive(spark, sf_dir):
    return C.archive(X.lakesp(spark, sf_dir)).select("lake_id", "cycle_number", "pass_number", "wse", "area_total")


EXT = """e as (select f.*, median(wse) over w as m, count(wse) over w as k from f window w as (partition by cycle_number, lake_id)),
  x as (select cycle_number, lake_id, max(k) as k,
    arg_min(struct_pack(w:=wse,a:=area_total,t:=time,p:=partial_f,u:=wse_u), struct_pack(x:=wse,y:=pass_number)) as lo,
    arg_min(struct_pack(w:=wse,a:=area_total,t:=time,p:=partial_f,u:=wse_u), struct_pack(x:=abs(wse-m),y:=pass_number)) as mi,
    arg_max(struct_pack(w:=wse,a:=area_total,t:=time,p:=partial_f,u:=wse_u), struct_pack(x:=wse,y:=-pass_number)) as hi from e group by 1,2)"""
EXT_COLS = ", ".join(f"case when {c} then {s}.{f} end as {n}_{x}" for x, s, c in (("hmin", "lo", "k>=2"), ("hmed", "mi", "k=1 or k>=3"), ("hmax", "hi", "k>=2")) for n, f in (("wse", "w"), ("area_total", "a")))


@query("with {lakesp}, " + FIRST + ", " + EXT + f" select cycle_number, lake_id, {EXT_COLS} from x")
def a21_extremes(spark, sf_dir):
    return C.extreme_rows(C.archive(X.lakesp(spark, sf_dir)), ["wse", "area_total"])


AVG = """a as (select cycle_number, lake_id, cast(count(*) as int) as npass, cast(sum(1-partial_f) as int) as npass_full, cast(sum(partial_f) as int) as npass_part,
    coalesce(string_agg(distinct case when partial_f=0 then pass_number end, ';' order by case when partial_f=0 then pass_number end),'') as pass_full,
    coalesce(string_agg(distinct case when partial_f=1 then pass_number end, ';' order by case when partial_f=1 then pass_number end),'') as pass_part,
    min(partial_f) as partial_f, avg(time) as t_avg, avg(wse) as wse_avg, sqrt(sum(wse_u*wse_u))/count(wse_u) as wse_avg_u, avg(geoid_hght) as geoid_hght from f group by 1,2)"""


@query("with {lakesp}, " + FIRST + ", " + AVG + " select cycle_number, lake_id, npass, npass_full, npass_part, pass_full, pass_part, partial_f, round(t_avg,3) as t_avg, round(wse_avg,8) as wse_avg, round(wse_avg_u,8) as wse_avg_u, round(geoid_hght,8) as geoid_hght from a")
def a22_averages(spark, sf_dir):
    return r6(C.averages(C.archive(X.lakesp(spark, sf_dir))).withColumn("t_avg", F.round("t_avg", 3)), digits=8)


NEAR = """m as (select cycle_number, lake_id, avg(wse) as m from f group by 1,2),
  nr as (select cycle_number, lake_id, arg_min(struct_pack(a:=area_total,u:=area_tot_u), struct_pack(x:=abs(wse-m),y:=pass_number)) as b from f join m using (cycle_number, lake_id) where partial_f=0 group by 1,2)"""


@query("with {lakesp}, " + FIRST + ", " + NEAR + " select cycle_number, lake_id, b.a as area_total, b.u as area_tot_u from nr")
def a23_nearest_full_pass(spark, sf_dir):
    return C.nearest_full_pass(C.archive(X.lakesp(spark, sf_dir)), ["area_total", "area_tot_u"])


_SHAPE = "cast(pass_number%7*3 as double) as x0, cast(pass_number%7*3+2+pass_number%4 as double) as x1, cast(pass_number%5*2 as double) as y0, cast(pass_number%5*2+3 as double) as y1"


def _shaped(lakes):
    """``lakes`` with a box of whole numbers as rings."""
    own = lakes.selectExpr("*", *(x.strip() for x in _SHAPE.replace(", cast", "|cast").split("|")))
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    ring = F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"), corner("x0", "y0"))
    return own.withColumn("rings", F.array(ring)).drop("x0", "x1", "y0", "y1")


@query("with {lakesp}, " + FIRST + ", " + NEAR + f""", s as (select *, {_SHAPE} from f), n as (select cycle_number, lake_id from f group by 1,2 having min(partial_f)=1),
  u as (select cycle_number, lake_id, count(distinct ix*1000+iy) as a from s join n using (cycle_number, lake_id), range(0,40) i(ix), range(0,40) j(iy) where ix>=x0 and ix<x1 and iy>=y0 and iy<y1 group by 1,2),
  v as (select cycle_number, lake_id, avg(area_tot_u) as u, count(*) as k from s join n using (cycle_number, lake_id) group by 1,2)
  select cycle_number, lake_id, round(b.a,6) as area_avg, round(b.u,8) as area_avg_u, cast(1 as int) as parts from nr union all select cycle_number, lake_id, cast(a as double), round(u,8), cast(k as int) from u join v using (cycle_number, lake_id)""")
def a23_cycle_shape(spark, sf_dir):
    out = C.cycle_shape(C.archive(_shaped(X.lakesp(spark, sf_dir))), [])
    return out.select("cycle_number", "lake_id", F.round("area_avg", 6).alias("area_avg"), F.round("area_avg_u", 8).alias("area_avg_u"), F.size("parts").alias("parts"))


def _bridge(spark, sf_dir):
    lakes = X.lakesp(spark, sf_dir).where("partial_f = 0 and quality_f < 2").select("lake_id", "cycle_number", "pass_number", "obs_id", "wse", "wse_u", F.col("area_total").alias("area"), F.col("area_tot_u").alias("area_u"), "partial_f", (F.col("n") * 10.0).alias("overlap"))
    return lakes.join(X.pld(spark, sf_dir), "lake_id")


_STORAGE = """b as (select lake_id, cycle_number, pass_number, obs_id, wse, wse_u, area_total as a, area_tot_u as au, ref_wse, coalesce(ref_wse_u,0) as r_u, ref_area, n*10.0 as overlap, ds_t0 from lakesp join pld using (lake_id) where partial_f=0 and quality_f<2),
  c as (select *, overlap/sum(overlap) over (partition by lake_id, cycle_number) as al, wse-ref_wse as d from b),
  e as (select *, al*ref_area as a0, sqrt(al*ref_area*a) as ro from c),
  s as (select lake_id, cycle_number, sum(d/2*(a0+a))/1000-coalesce(max(case when ds_t0>=-9e7 then ds_t0 end),0) as ds_l, sum(d/3*(a0+a+ro))/1000-coalesce(max(case when ds_t0>=-9e7 then ds_t0 end),0) as ds_q,
    sqrt(sum(pow((a0+a)/2*wse_u,2))+sum(pow(d/2*au,2))+pow(sum((a0+a)/2)*max(r_u),2))/1000 as ds_l_u,
    sqrt(sum(pow((a0+a+ro)/3*wse_u,2))+sum(pow(d/3*(1+sqrt(a0/a)/2)*au,2))+pow(sum((a0+a+ro)/3)*max(r_u),2))/1000 as ds_q_u from e group by 1,2)"""


@query("with {lakesp}, {pld}, " + _STORAGE + " select lake_id, cycle_number, round(ds_l,8) as ds_l, round(ds_l_u,8) as ds_l_u, round(ds_q,8) as ds_q, round(ds_q_u,8) as ds_q_u from s")
def d4_storage_change(spark, sf_dir):
    return r6(C.storage_change(_bridge(spark, sf_dir), ["lake_id", "cycle_number"]), digits=8)


@query("with {lakesp}, {pld}, " + _STORAGE + """ select obs_id, round(sum(al*ds_l),8) as ds_l, round(sum(al*ds_q),8) as ds_q, round(sqrt(sum(pow(al*ds_l_u,2))),8) as ds_l_u, round(sqrt(sum(pow(al*ds_q_u,2))),8) as ds_q_u from e join s using (lake_id, cycle_number) group by 1""")
def d5_shared_storage(spark, sf_dir):
    b = _bridge(spark, sf_dir)
    keys = ["lake_id", "cycle_number"]
    return r6(C.share_storage(C.storage_change(b, keys), b.select(*keys, "obs_id", "overlap"), ["obs_id"], keys), digits=8)


_D8 = "with {lakesp}, {pld}, " + FIRST + ", " + EXT + ", " + AVG + ", " + NEAR + f""",
  o as (select a.*, {EXT_COLS}, nr.b.a as area_avg, nr.b.u as area_avg_u from a join x using (cycle_number, lake_id) left join nr using (cycle_number, lake_id)),
  s as (select cycle_number, lake_id, (wse_avg-ref_wse)/2*(ref_area+area_avg)/1000-coalesce(case when ds_t0>=-9e7 then ds_t0 end,0) as dl,
    (wse_avg-ref_wse)/3*(ref_area+area_avg+sqrt(ref_area*area_avg))/1000-coalesce(case when ds_t0>=-9e7 then ds_t0 end,0) as dq from o join pld using (lake_id) where area_avg is not null)
  select cycle_number, lake_id, npass, pass_full, pass_part, round(wse_avg,7) as wse_avg, wse_hmin, wse_hmed, wse_hmax, area_avg, round(dl,7) as ds1_l_avg, round(dq,7) as ds1_q_avg from o left join s using (cycle_number, lake_id)"""


@query(_D8 + " union all select null, lake_id, 0, null, null, null, null, null, null, null, null, null from pld where lake_id not in (select lake_id from lakesp)")
def d8_s16_cycle_product(spark, sf_dir):
    out = C.cycle_product(X.lakesp(spark, sf_dir), X.pld(spark, sf_dir), add_all=True)
    return r6(out.select("cycle_number", "lake_id", "npass", "pass_full", "pass_part", "wse_avg", "wse_hmin", "wse_hmed", "wse_hmax", "area_avg", "ds1_l_avg", "ds1_q_avg"), digits=7)


_UNION = f"""s1 as (select *, {_SHAPE} from f), n1 as (select cycle_number, lake_id from f group by 1,2 having min(partial_f)=1),
  u1 as (select distinct cycle_number, lake_id, ix, iy from s1 join n1 using (cycle_number, lake_id), range(0,40) i(ix), range(0,40) j(iy) where ix>=x0 and ix<x1 and iy>=y0 and iy<y1)"""


@query("with {lakesp_part}, " + FIRST + ", " + _UNION + """, q as (select cycle_number, lake_id, x, y, max(case when ix=x and iy=y then 1 else 0 end) as ne, max(case when ix=x-1 and iy=y then 1 else 0 end) as nw, max(case when ix=x and iy=y-1 then 1 else 0 end) as se, max(case when ix=x-1 and iy=y-1 then 1 else 0 end) as sw
    from (select *, ix+i as x, iy+j as y from u1, range(0,2) a(i), range(0,2) b(j)) group by 1,2,3,4)
  select cycle_number, lake_id, sum(case when ne+nw+se+sw in (1,3) then 1 when ne+nw+se+sw=2 and ne=sw then 2 else 0 end)::bigint as n_vertices, min(x)::double as x0, max(x)::double as x1, min(y)::double as y0, max(y)::double as y1,
    (select count(*) from u1 where u1.cycle_number=q.cycle_number and u1.lake_id=q.lake_id)::double as area from q group by 1,2""")
def a23_g6_union_shapes(spark, sf_dir):
    """Rings of the lakes that no pass saw whole: their corners, extents and area, against a count of unit cells."""
    own = C.archive(_shaped(X.lakesp_part(spark, sf_dir)))
    whole = own.where("partial_f = 0").select("cycle_number", "lake_id").distinct()
    u = G.union_polygons(own.join(whole, ["cycle_number", "lake_id"], "left_anti"), ["cycle_number", "lake_id"], "pass_number")
    ends = lambda f, k: f(F.flatten(F.transform("rings", lambda r: F.transform(r, lambda p: p[k]))))
    corners = F.aggregate("rings", F.lit(0).cast("long"), lambda a, r: a + F.size(r) - 1)
    return u.select("cycle_number", "lake_id", corners.alias("n_vertices"), ends(F.array_min, "x").alias("x0"), ends(F.array_max, "x").alias("x1"), ends(F.array_min, "y").alias("y0"), ends(F.array_max, "y").alias("y1"), F.round(G.rings_area(F.col("rings")), 6).alias("area"))


_D8_SHAPES = _D8.replace("  o as (select", "  " + _UNION + """, ua as (select cycle_number, lake_id, count(*)::double as a from u1 group by 1,2), uu as (select cycle_number, lake_id, avg(area_tot_u) as u from f join n1 using (cycle_number, lake_id) group by 1,2),
  o as (select""").replace("nr.b.a as area_avg, nr.b.u as area_avg_u from", "coalesce(nr.b.a, ua.a) as area_avg, coalesce(nr.b.u, uu.u) as area_avg_u from").replace("left join nr using (cycle_number, lake_id))", "left join nr using (cycle_number, lake_id) left join ua using (cycle_number, lake_id) left join uu using (cycle_number, lake_id))")


@query(_D8_SHAPES.replace("{lakesp}", "{lakesp_part}").replace("  select cycle_number, lake_id, npass, ", "  select cycle_number, lake_id, area_avg is not null and exists (select 1 from n1 where n1.cycle_number=o.cycle_number and n1.lake_id=o.lake_id) as united, round(area_avg_u,7) as area_avg_u, npass, "))
def d8_a23_cycle_with_shapes(spark, sf_dir):
    """The cycle product with geometry: lakes that no pass saw whole take the union of their partial shapes, its area and a storage change."""
    out = C.cycle_product(_shaped(X.lakesp_part(spark, sf_dir)), X.pld(spark, sf_dir))
    united = F.col("rings").isNotNull() & (F.col("npass_full") == 0)
    return r6(out.select("cycle_number", "lake_id", united.alias("united"), "area_avg_u", "npass", "pass_full", "pass_part", "wse_avg", "wse_hmin", "wse_hmed", "wse_hmax", "area_avg", "ds1_l_avg", "ds1_q_avg"), digits=7)


@query("""with o as (select distinct cast(o_orderdate as date) as d from orders), l as (select distinct cast(l_shipdate as date) as s from lineitem),
  j as (select d, s, row_number() over (partition by d order by abs(s-d), s) as r from o left join l on abs(s-d)<=99)
  select d as acquired, s as nearest from j where r=1""")
def j21_nearest_date(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("acquired")).distinct()
    m = X.table(spark, sf_dir, "lineitem")
    return C.nearest_date(o, m, "acquired", "l_shipdate")


@query("""with p as (select cast(s_suppkey as int) as orbit, cast(s_suppkey*1237%1802822 as bigint) as o from supplier),
  c as (select p.*, k as cycle, (k-1)*1802822+o as mt from p, range(1,30) t(k))
  select cast(cycle as int) as cycle, orbit, mt as mission_time, strftime(timestamp '2022-01-01'+to_seconds(mt),'%Y-%m-%d %H:%M:%S') as date from c
  where timestamp '2022-01-01'+to_seconds(mt) between timestamp '2022-03-01' and timestamp '2022-06-01 12:00:00'""")
def d10_pass_plan(spark, sf_dir):
    p = X.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("int").alias("orbit"), (F.col("s_suppkey") * 1237 % 1802822).cast("long").alias("offset_s"))
    return C.pass_plan(p, "2022-01-01 00:00:00", 1802822 / 86400, "2022-03-01 00:00:00", "2022-06-01 12:00:00")


# Scalars --------------------------------------------------------------------------------------


@query("with p as (select c_custkey, c_custkey*7.3e0%720-360 as lon from customer) select c_custkey, round(case when lon>180 then lon-360 else lon end,6) as a, round(case when lon<0 then lon+360 else lon end,6) as b from p")
def x1_longitudes(spark, sf_dir):
    lon = F.col("c_custkey") * 7.3 % 720 - 360
    return r6(X.table(spark, sf_dir, "customer").select("c_custkey", S.lon_180(lon).alias("a"), S.lon_360(lon).alias("b")))


@query("""with p as (select c_custkey, make_timestamp(946684800000000+cast(c_custkey*100000*1000000+c_custkey*250000 as bigint)) as t from customer)
  select c_custkey, strftime(t,'%Y-%m-%d %H:%M:%S.%fZ') as t0, strftime(t,'%Y-%m-%d %H:%M:%S') as t1, strftime(t,'%Y-%m-%dT%H:%M:%S.%fZ') as t2, strftime(t,'%Y-%m-%dT%H:%M:%S') as t3 from p""")
def x2_time_texts(spark, sf_dir):
    s = F.col("c_custkey") * 100000 + F.col("c_custkey") * 0.25
    return X.table(spark, sf_dir, "customer").select("c_custkey", *(S.time_text(s, k).alias(f"t{k}") for k in range(4)))


@query("""with p as (select c_custkey, c_custkey*7.3e0%360-180 as lon, c_custkey*3.7e0%160-80 as lat from customer)
  select c_custkey, concat(case when lat>=0 then '326' else '327' end, lpad(cast(cast(floor((lon+180)/6) as int)%60+1 as varchar),2,'0')) as epsg from p""")
def x3_utm_codes(spark, sf_dir):
    lon, lat = F.col("c_custkey") * 7.3 % 360 - 180, F.col("c_custkey") * 3.7 % 160 - 80
    return X.table(spark, sf_dir, "customer").select("c_custkey", S.utm_epsg(lon, lat).alias("epsg"))


@query("with p as (select c_custkey, c_custkey*7.3e0%360-180 as lon, c_custkey*3.7e0%160-80 as lat from customer) select c_custkey, round(lon,8) as lon, round(lat,8) as lat from p")
def x3_utm_round_trip(spark, sf_dir):
    p = X.table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") * 7.3 % 360 - 180).alias("lon"), (F.col("c_custkey") * 3.7 % 160 - 80).alias("lat"))
    zone, north = S.utm_zone(F.col("lon")), F.col("lat") >= 0
    e, n = S.to_utm(F.col("lon"), F.col("lat"), zone, north)
    p = p.withColumns({"e": e, "n": n, "zone": zone, "north": north})
    lon, lat = S.from_utm(F.col("e"), F.col("n"), F.col("zone"), F.col("north"))
    return p.select("c_custkey", F.round(lon, 8).alias("lon"), F.round(lat, 8).alias("lat"))


@query(f"""with {{pixc}} select {KEYS}, round(height-pole_tide-load_tide_got-load_tide_fes-solid_earth_tide-geoid,6) as elevation, cast(round_even(illumination_time/3600,0) as bigint) as hour,
  round(10/sin(incidence),6) as spacing from pixc where not isnan(height) and not isinf(pole_tide)""")
def x4_elevation(spark, sf_dir):
    c = F.col
    p = X.pixc(spark, sf_dir).where("not isnan(height) and pole_tide < double('Infinity')")
    el = S.surface_elevation(c("height"), c("geoid"), c("solid_earth_tide"), c("pole_tide"), c("load_tide_got"), c("load_tide_fes"))
    return r6(p.select(*KEY, el.alias("elevation"), S.hour_bucket(c("illumination_time")).alias("hour"), S.range_spacing(F.lit(10.0), c("incidence"), F.lit(9e5), F.lit(9.1e5), c("range_index")).alias("spacing")))


@query(f"""with {{pixc}}, a as (select *, radians(latitude) as f, radians(longitude) as l, 6378137.0/sqrt(1-(1-pow(6356752.31424518/6378137.0,2))*pow(sin(radians(latitude)),2)) as nn from pixc where not isnan(height))
  select {KEYS}, round((nn+height)*cos(f)*cos(l),3) as x, round((nn+height)*cos(f)*sin(l),3) as y, round((nn*pow(6356752.31424518/6378137.0,2)+height)*sin(f),3) as z, round(degrees(atan2(cos(f)*sin(l),cos(f)*cos(l))),8) as lon, round(degrees(atan2(sin(f),abs(cos(f)))),8) as lat, round(height,4) as h from a""")
def x5_ecef(spark, sf_dir):
    """There and back: tiles run on over the pole, where the way back names a place by its latitude within 90 degrees."""
    x, y, z = S.to_ecef(F.col("longitude"), F.col("latitude"), F.col("height"))
    p = X.pixc(spark, sf_dir).where("not isnan(height)").withColumns({"x": x, "y": y, "z": z})
    lon, lat, h = S.from_ecef(F.col("x"), F.col("y"), F.col("z"))
    return p.select(*KEY, *(F.round(k, 3).alias(k) for k in "xyz"), F.round(lon, 8).alias("lon"), F.round(lat, 8).alias("lat"), F.round(h, 4).alias("h"))


@query(f"""with {{pixc}}, e as (select *, -sin(0.1)*cross_track+cos(0.1)*height as e, -sin(0.8)*(cos(0.1)*cross_track+sin(0.1)*height)+cos(0.8)*pixel_area as nn, cos(0.8)*(cos(0.1)*cross_track+sin(0.1)*height)+sin(0.8)*pixel_area as u from pixc where not isnan(height))
  select {KEYS}, round(e,5) as e, round(nn,5) as n, round(u,5) as u, round(case when degrees(atan2(e,nn))<0 then degrees(atan2(e,nn))+360 else degrees(atan2(e,nn)) end,7) as az, round(degrees(atan2(u,sqrt(e*e+nn*nn))),7) as el, round(sqrt(e*e+nn*nn+u*u),5) as r from e""")
def x6_local_frames(spark, sf_dir):
    c = F.col
    e, n, u = S.to_enu(c("cross_track"), c("height"), c("pixel_area"), F.degrees(F.lit(0.1)), F.degrees(F.lit(0.8)))
    p = X.pixc(spark, sf_dir).where("not isnan(height)").withColumns({"e": e, "n": n, "u": u})
    az, el, r = S.to_aer(c("e"), c("n"), c("u"))
    return p.select(*KEY, *(F.round(k, 5).alias(k) for k in "enu"), F.round(az, 7).alias("az"), F.round(el, 7).alias("el"), F.round(r, 5).alias("r"))


@query("""with p as (select c_custkey, radians(c_custkey*7.3e0%360-180) as l1, radians(c_custkey*3.7e0%160-80) as f1, radians(c_custkey*5.1e0%360-180) as l2, radians(c_custkey*2.9e0%160-80) as f2 from customer)
  select c_custkey, case when abs(f2-f1)<1.7e-11 and abs(sin((l2-l1)/2))<1e-11 then 0 else round(6371008.8*acos(greatest(-1,least(1,sin(f1)*sin(f2)+cos(f1)*cos(f2)*cos(l2-l1)))),2) end as d from p""")
def x7_great_circle(spark, sf_dir):
    k = F.col("c_custkey")
    d = S.great_circle(k * 7.3 % 360 - 180, k * 3.7 % 160 - 80, k * 5.1 % 360 - 180, k * 2.9 % 160 - 80)
    return X.table(spark, sf_dir, "customer").select("c_custkey", F.round(d, 2).alias("d"))


@query("with {pld} select lake_id, coalesce(ref_area_u,-99999999) as o, nullif(ds_t0,-99999999) as i, coalesce(nullif(ds_t0,-99999999),9.96921e36) as r from pld")
def x8_fill_values(spark, sf_dir):
    c = F.col
    return X.pld(spark, sf_dir).select("lake_id", S.fill_out(c("ref_area_u"), -99999999.0).alias("o"), S.fill_in(c("ds_t0"), -99999999.0).alias("i"), S.refill(c("ds_t0"), -99999999.0, 9.96921e36).alias("r"))


@query("""with p as (select c_custkey, cast(c_custkey%10 as varchar) as d, c_custkey%800 as cyc from customer), q as (select *, case d when '1' then 'AF' when '2' then 'EU' when '3' then 'SI' when '4' then 'AS' when '5' then 'AU' when '6' then 'SA' when '7' then 'NA' when '8' then 'AR' when '9' then 'GR' else 'None' end as continent from p)
  select c_custkey, continent, case when continent='None' then 'None' else d end as digit, case when cyc<400 then 'science' else 'calval' end as phase from q""")
def x9_continents(spark, sf_dir):
    p = X.table(spark, sf_dir, "customer").withColumn("continent", S.continent_of((F.col("c_custkey") % 10).cast("string")))
    return p.select("c_custkey", "continent", S.continent_digit(F.col("continent")).alias("digit"), S.orbit_phase(F.col("c_custkey") % 800).alias("phase"))


@query("""select s_suppkey, concat('742', lpad(cast(s_suppkey%1000 as varchar),3,'0'), case when s_suppkey%2=0 then 'L' else 'R' end, lpad(cast(s_suppkey as varchar),6,'0')) as obs_id,
  printf('OUT_Obs_%03d_%03d_%03d%s_20240101T000000_20240101T000100_PIC0_%02d.shp', s_suppkey%600, s_suppkey%584, s_suppkey%308, case when s_suppkey%2=0 then 'L' else 'R' end, s_suppkey%100) as name from supplier""")
def x10_x13_names(spark, sf_dir):
    k, side = F.col("s_suppkey"), F.when(F.col("s_suppkey") % 2 == 0, "L").otherwise("R")
    tile = F.concat(F.lpad((k % 308).cast("string"), 3, "0"), side)
    name = S.product_name("OUT_Obs", k % 600, k % 584, tile, F.lit("20240101T000000"), F.lit("20240101T000100"), F.lit("PIC0"), k % 100, ".shp")
    return X.table(spark, sf_dir, "supplier").select("s_suppkey", S.obs_id(F.lit("7421"), k % 1000, side, k).alias("obs_id"), name.alias("name"))


@query(f"""with {{pixc}}, p as (select *, 2*pi()/0.0084*(power_minus_y-power_plus_y)*0.001 as ph from pixc)
  select {KEYS}, round(ifg_re*cos(ph)+ifg_im*sin(ph),8) as re, round(ifg_im*cos(ph)-ifg_re*sin(ph),8) as im, round(atan2(sqrt(pow(ifg_im*3-water_frac*2,2)+pow(water_frac-ifg_re*3,2)+pow(ifg_re*2-ifg_im,2)),ifg_re+ifg_im*2+water_frac*3),8) as angle from p""")
def x11_x12_phase_and_angle(spark, sf_dir):
    c = F.col
    re, im = S.flatten_interferogram(c("ifg_re"), c("ifg_im"), c("power_plus_y") * 0.001, c("power_minus_y") * 0.001, 0.0084)
    one, two, three = F.lit(1.0), F.lit(2.0), F.lit(3.0)
    return r6(X.pixc(spark, sf_dir).select(*KEY, re.alias("re"), im.alias("im"), S.angle_between(c("ifg_re"), c("ifg_im"), c("water_frac"), one, two, three).alias("angle")), digits=8)


@query(f"with {{pixc}} select {KEYS}, round((height-10)*3.5+10,6) as h, round(height+geoid+load_tide_fes+solid_earth_tide+0.001,6) as e from pixc where not isnan(height)")
def x15_x17_heights(spark, sf_dir):
    c = F.col
    return r6(X.pixc(spark, sf_dir).where("not isnan(height)").select(*KEY, S.exaggerate(c("height"), 3.5, 10.0).alias("h"), S.node_ellipsoid_height(c("height"), c("geoid"), c("load_tide_fes"), c("solid_earth_tide"), F.lit(0.001)).alias("e")))
