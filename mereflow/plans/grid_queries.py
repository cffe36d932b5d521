"""Queries of labels, neighbours and rasters."""

from __future__ import annotations

from pyspark.sql import functions as F

from mereflow import fixtures as X
from mereflow.operators import labels as L
from mereflow.operators import neighbours as N
from mereflow.plans.queries import KEY, KEYS, r6

QUERIES: dict = {}
ORACLE: dict = {}


def query(sql=None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql.replace("{pixc}", X.PIXC_SQL).replace("{poly}", X.POLY_SQL)
        return f

    return put


def _reach(where: str, near: str) -> str:
    """SQL that labels pixels by all that they reach."""
    return f"""with recursive {{pixc}}, p as materialized (select tile_number as t, azimuth_index as a, range_index as r, tile_number*1099511627776+azimuth_index*1048576+range_index as id, pixel_area, height from pixc where {where}),
  e as materialized (select p.id as i, q.id as j from p join p q on q.t=p.t and q.a between p.a-1 and p.a+1 and q.r between p.r-1 and p.r+1 and {near}),
  w(i, j) as (select id, id from p union select w.i, e.j from w join e on w.j=e.i),
  l as (select i as id, min(j) as label from w group by 1)"""


FOUR, EIGHT = "abs(q.a-p.a)+abs(q.r-p.r)=1", "q.id<>p.id"
WATER = "classification in (3,4,5,6,7)"


def _water(spark, sf_dir, where=WATER):
    return X.pixc(spark, sf_dir).where(where)


@query(_reach(WATER, FOUR) + " select t as tile_number, r as range_index, a as azimuth_index, label from p join l using (id)")
def c1_lake_labels(spark, sf_dir):
    return L.lake_labels(_water(spark, sf_dir)).select(*KEY, "label")


@query(_reach("classification in (3,4)", EIGHT) + " select t as tile_number, r as range_index, a as azimuth_index, label from p join l using (id)")
def c1_labels_diagonal(spark, sf_dir):
    return L.lake_labels(_water(spark, sf_dir, "classification in (3,4)"), diagonal=True).select(*KEY, "label")


@query(_reach("classification in (3,4)", EIGHT) + ", s as (select label from p join l using (id) group by 1 having sum(pixel_area)>400) select t as tile_number, r as range_index, a as azimuth_index, label from p join l using (id) where label in (select label from s)")
def a24_large_regions(spark, sf_dir):
    return L.large_regions(L.lake_labels(_water(spark, sf_dir, "classification in (3,4)"), diagonal=True), 400.0).select(*KEY, "label")


_FLAGS = _reach(WATER, FOUR) + """, x as (select t, max(a) as top from p group by 1),
  f as (select t, label, max(case when a=0 then 1 else 0 end) as b, max(case when a=top then 1 else 0 end) as tp from p join l using (id) join x using (t) group by 1,2),
  g as (select t, label, case when b=1 and tp=1 then 2 when tp=1 then 1 when b=1 then 0 end as edge_loc from f)"""


@query(_FLAGS + " select t as tile_number, label, edge_loc from g")
def u4_border_flags(spark, sf_dir):
    return L.border_flags(L.lake_labels(_water(spark, sf_dir)))


@query(_FLAGS + " select p.t as tile_number, r as range_index, a as azimuth_index, label, edge_loc from p join l using (id) join g using (t, label) where edge_loc is not null")
def u5_s15_edge_pixels(spark, sf_dir):
    return L.edge_pixels(L.lake_labels(_water(spark, sf_dir))).select(*KEY, "label", "edge_loc")


_META = """meta as (select distinct 1 as pass_number, tile_number, 800000+tile_number*tile_number*2.3 as near_range, 0.75 as nominal_slant_range_spacing, 96 as interferogram_size_azimuth from pixc where tile_number%5<>4)"""


def _meta(spark, sf_dir):
    t = F.col("tile_number")
    p = X.pixc(spark, sf_dir).where("tile_number % 5 <> 4").select("tile_number").distinct()
    return p.select(F.lit(1).alias("pass_number"), t, (800000 + t * t * 2.3).alias("near_range"), F.lit(0.75).alias("nominal_slant_range_spacing"), F.lit(96).alias("interferogram_size_azimuth"))


@query("""with {pixc}, """ + _META + """ select cast(t as bigint) as tile_number, 1 as pass_number from range((select min(tile_number) from meta), (select max(tile_number)+1 from meta)) r(t) where t not in (select tile_number from meta)""")
def s9_missing_tiles(spark, sf_dir):
    return L.missing_tiles(_meta(spark, sf_dir), ["pass_number"]).select("tile_number", "pass_number")


_LAYOUT = """o as (select *, lag(tile_number) over w as b, lead(tile_number) over w as af, lag(near_range) over w as nb from meta window w as (order by tile_number)),
  y as (select tile_number, b is null or tile_number-b>1 as starts, af is null or af-tile_number>1 as ends,
    sum(case when b is null then 0 else 96+(tile_number-b-1)*96 end) over (order by tile_number) as azimuth_offset,
    sum(coalesce(round_even((near_range-nb)/0.75,0),0)) over (order by tile_number) as range_offset from o)"""


@query("with {pixc}, " + _META + ", " + _LAYOUT + " select 1 as pass_number, tile_number, cast(azimuth_offset as bigint) as azimuth_offset, cast(range_offset as bigint) as range_offset, starts, ends from y")
def w3_w4_w5_tile_layout(spark, sf_dir):
    return L.tile_layout(_meta(spark, sf_dir), ["pass_number"])


_MERGE = _reach(WATER, FOUR).replace("with recursive {pixc},", "with recursive {pixc}, " + _META + ", " + _LAYOUT + ",") + """, z as (select t, label, a, r+range_offset as rr, max(a) over (partition by t) as top from p join l using (id) join y on y.tile_number=p.t),
  k as (select distinct u.label as i, v.label as j from z u join z v on v.t=u.t+1 and u.a=u.top and v.a=0 and u.rr=v.rr),
  kk as (select i, j from k union select j, i from k),
  m(i, j) as (select distinct label, label from z union select m.i, kk.j from m join kk on m.j=kk.i)
  select distinct z.t as tile_number, label, mm as merged from z join (select i, min(j) as mm from m group by 1) q on q.i=label"""


@query(_MERGE)
def c2_j17_merge_tiles(spark, sf_dir):
    own = L.lake_labels(_water(spark, sf_dir).where("tile_number % 5 <> 4")).withColumn("pass_number", F.lit(1))
    return L.merge_tiles(own, L.tile_layout(_meta(spark, sf_dir), ["pass_number"]), ["pass_number"])


@query(_reach(WATER, FOUR) + ", c as (select t, label, count(*) as k from p join l using (id) group by 1,2) select t as tile_number, label, dense_rank() over (partition by t order by k desc, label) as number from c")
def w7_number_by_size(spark, sf_dir):
    return L.number_by_size(L.lake_labels(_water(spark, sf_dir)), ["tile_number"])


@query(f"""with {{pixc}}, h as (select distinct tile_number, lake, height from pixc where not isnan(height)),
  g as (select *, case when height-lag(height) over (partition by tile_number, lake order by height)>1.5/sqrt(2) then 1 else 0 end as g from h),
  c as (select tile_number, lake, height, sum(g) over (partition by tile_number, lake order by height) as cluster from g)
  select {KEYS}, cast(cluster as bigint) as cluster from pixc join c using (tile_number, lake, height)""")
def w6_c5_height_gaps(spark, sf_dir):
    return L.height_gaps(X.pixc(spark, sf_dir), ["tile_number", "lake"]).select(*KEY, "cluster")


@query(f"""with {{pixc}}, p as (select {KEYS}, tile_number*100+lake as label, case when isnan(height) then 7.0 when height>25 then 30+height/50 else 5+height/50 end as height, pixel_area from pixc),
  b as (select label, min(height) as h0, max(height) as h1, count(*) as k, avg(pixel_area) as pa from p group by 1 having count(*)>=5 and count(*)*avg(pixel_area)>=2*2000 and max(height)>min(height)),
  i as (select label, least(floor((height-h0)/((h1-h0)/256)),255) as bin, h0, (h1-h0)/256 as st from p join b using (label)),
  hh as (select label, bin, count(*) as c, max(h0+(bin+0.5)*st) as x from i group by 1,2),
  cu as (select *, sum(c) over u as w1, sum(c*x) over u as s1, sum(c) over a as w, sum(c*x) over a as s from hh window u as (partition by label order by bin), a as (partition by label)),
  v as (select *, round(w1*(w-w1)*pow(s1/w1-(s-s1)/(w-w1),2),6) as v from cu where w>w1),
  t as (select label, arg_max(x, struct_pack(v:=v,b:=-bin)) as th from v group by 1),
  q as (select label, height>th as side, count(*) as n, avg(height) as m, stddev_pop(height) as sd, max(th) as th, max(pa) as pa from p join t using (label) join b using (label) group by 1,2),
  ok as (select label from q group by 1 having count(*)=2 and min(case when n*pa>=2000 and n>5 and abs(th-m)>2*sd then 1 else 0 end)=1)
  select {KEYS}, cast(case when label in (select label from ok) and height>(select th from t where t.label=p.label) then 1 else 0 end as int) as part from p""")
def c3_otsu_split(spark, sf_dir):
    h = F.when(F.isnan("height"), 7.0).when(F.col("height") > 25, 30 + F.col("height") / 50).otherwise(5 + F.col("height") / 50)
    own = X.pixc(spark, sf_dir).select(*KEY, (F.col("tile_number") * 100 + F.col("lake")).alias("label"), h.alias("height"), "pixel_area")
    return L.otsu_split(own, ["label"], 2000.0).select(*KEY, "part")


@query(f"""with {{pixc}}, p as (select {KEYS}, classification as label from pixc), z as (select tile_number, label, count(*) as n from p group by 1,2),
  lg as (select tile_number, label from z where n>=500), o as (select tile_number, min(label) as one from z group by 1 having max(n)<500),
  v as (select p.tile_number, p.label, q.label as near, count(*) as n from p join p q on q.tile_number=p.tile_number and abs(q.azimuth_index-p.azimuth_index)+abs(q.range_index-p.range_index)=1 and q.azimuth_index between p.azimuth_index-1 and p.azimuth_index+1
    join lg on lg.tile_number=q.tile_number and lg.label=q.label where (p.tile_number, p.label) not in (select tile_number, label from lg) group by 1,2,3),
  ch as (select tile_number, label, arg_max(near, struct_pack(n:=n,m:=-near)) as near from v group by 1,2)
  select p.tile_number, p.range_index, p.azimuth_index, coalesce(one, near, p.label) as label from p left join ch on ch.tile_number=p.tile_number and ch.label=p.label left join o on o.tile_number=p.tile_number""")
def c6_absorb_small(spark, sf_dir):
    own = X.pixc(spark, sf_dir).select(*KEY, F.col("classification").alias("label"))
    return L.absorb_small(own, ["tile_number"], 500).select(*KEY, "label")


# Points: suppliers and orders laid out in the plane
_PTS = """pts as (select o_orderkey as id, cast(o_orderkey*7919%1000 as double)+o_custkey%7/10.0 as x, cast(o_orderkey*104729%1000 as double)+o_custkey%11/20.0 as y, o_totalprice/10000 as z, cast(o_custkey%3 as int) as mask from orders)"""


def _points(spark, sf_dir):
    return X.table(spark, sf_dir, "orders").selectExpr("o_orderkey as id", "cast(o_orderkey*7919%1000 as double)+o_custkey%7/10.0D as x", "cast(o_orderkey*104729%1000 as double)+o_custkey%11/20.0D as y", "o_totalprice/10000 as z", "cast(o_custkey%3 as int) as mask")


def _cells(r: str) -> str:
    return f"""box as (select cast(floor(min(x)/{r}) as bigint) as x0, cast(ceil(max(x)/{r}) as bigint)-1 as x1, cast(floor(min(y)/{r}) as bigint) as y0, cast(ceil(max(y)/{r}) as bigint)-1 as y1 from pts),
  cells as (select ix, iy, (ix+0.5e0)*{r} as x, (iy+0.5e0)*{r} as y from box, range(x0, x1+1) a(ix), range(y0, y1+1) b(iy))"""


@query("with " + _PTS + ", " + _cells("50") + " select ix, iy, x, y from cells")
def r1_grid(spark, sf_dir):
    return N.grid(_points(spark, sf_dir), 50.0)


_KNN = """k as (select ix, iy, p.id, z, sqrt(pow(p.x-c.x,2)+pow(p.y-c.y,2)) as d, row_number() over (partition by ix, iy order by sqrt(pow(p.x-c.x,2)+pow(p.y-c.y,2)), p.id) as rank from cells c, pts p)"""


@query("with " + _PTS + ", " + _cells("50") + ", " + _KNN + " select ix, iy, id, rank, round(d,6) as d from k where rank<=4")
def j18_t4_nearest(spark, sf_dir):
    cells = N.grid(_points(spark, sf_dir), 50.0).withColumn("c", F.struct("ix", "iy"))
    near = N.nearest(cells.select("c", "x", "y"), _points(spark, sf_dir).select("id", "x", "y"), 4, "c", "id", 10.0)
    return r6(near.select("c.ix", "c.iy", F.col("id_r").alias("id"), "rank", "d"))


@query("with " + _PTS + " select a.id, b.id as other, round(sqrt(pow(a.x-b.x,2)+pow(a.y-b.y,2)),6) as d from pts a join pts b on b.x between a.x-12 and a.x+12 and b.y between a.y-12 and a.y+12 where sqrt(pow(a.x-b.x,2)+pow(a.y-b.y,2))<=12")
def j19_within_radius(spark, sf_dir):
    p = _points(spark, sf_dir).select("id", "x", "y")
    return N.within_by_place(p, p, 12.0, "id", "id", 6).select("id", F.col("id_r").alias("other"), "d")


@query("with " + _PTS + " select a.id from pts a join pts b on b.x between a.x-15 and a.x+15 and b.y between a.y-15 and a.y+15 where sqrt(pow(a.x-b.x,2)+pow(a.y-b.y,2))<=15 group by 1 having count(*)>3")
def c9_isolated_points(spark, sf_dir):
    return N.isolated_points(_points(spark, sf_dir), 15.0, 3).select("id")


@query("with recursive " + _PTS + """, e as materialized (select a.id as i, b.id as j from pts a join pts b on b.x between a.x-9 and a.x+9 and b.y between a.y-9 and a.y+9 where sqrt(pow(a.x-b.x,2)+pow(a.y-b.y,2)+pow(a.z-b.z,2))<=9),
  w(i, j) as (select id, id from pts union select w.i, e.j from w join e on w.j=e.i), l as (select i as id, min(j) as root from w group by 1), s as (select root from l group by 1 having count(*)>=3) select id from l join s using (root)""")
def c7_small_components(spark, sf_dir):
    return N.small_components(_points(spark, sf_dir), 9.0, 3).select("id")


@query("with recursive " + _PTS + """, e as materialized (select a.id as i, b.id as j from pts a join pts b on b.x between a.x-9 and a.x+9 and b.y between a.y-9 and a.y+9 where sqrt(pow(a.x-b.x,2)+pow(a.y-b.y,2)+pow(a.z-b.z,2))<=9),
  w(i, j) as (select id, id from pts union select w.i, e.j from w join e on w.j=e.i), l as materialized (select i as id, min(j) as root from w group by 1), s as (select root, count(*) as n from l group by 1),
  q as materialized (select p.*, root, n from pts p join l using (id) join s using (root)),
  k as (select distinct a.root from q a join q b on b.x between a.x-14 and a.x+14 and b.y between a.y-14 and a.y+14 where a.n<3 and a.root<>b.root and sqrt(pow(a.x-b.x,2)+pow(a.y-b.y,2)+pow(a.z-b.z,2))<=14)
  select id, cast(n>=3 as boolean) as large from q where n>=3 or root in (select root from k)""")
def c7_isolated_components(spark, sf_dir):
    """Points of large components and of small ones that have another component near."""
    kept = N.small_components(_points(spark, sf_dir), 9.0, 3, alone=14.0, size="n")
    return kept.select("id", (F.col("n") >= 3).alias("large"))


@query("with " + _PTS + """, k as (select a.id, sqrt(pow(a.x-b.x,2)+pow(a.y-b.y,2)) as d, row_number() over (partition by a.id order by sqrt(pow(a.x-b.x,2)+pow(a.y-b.y,2)), b.id) as r from pts a join pts b on b.x between a.x-150 and a.x+150 and b.y between a.y-150 and a.y+150),
  m as (select id, sum(d)/4 as m from k where r<=5 group by 1) select id from m where m<=(select avg(m)+1.0*stddev_pop(m) from m)""")
def c8_outliers_removed(spark, sf_dir):
    return N.outliers_removed(_points(spark, sf_dir), 4, 1.0, 15.0).select("id")


@query("with " + _PTS + ", " + _cells("50") + ", " + _KNN + """, g as (select ix, iy, sum(z/(d+1e-9))/sum(1/(d+1e-9)) as z, min(d) as mi, avg(d) as me, abs(stddev_pop(z)/avg(z)) as re from k where rank<=5 group by 1,2)
  select ix, iy, round(z,6) as z, round(mi,6) as min_dist, round(me,6) as mean_dist, round(re,6) as z_rel, case when re>0.3 and me*40>500 then 4 when me*40>500 then 3 when re>0.1 then 2 else 1 end as quality from g""")
def r2_idw_grid(spark, sf_dir):
    p = _points(spark, sf_dir)
    out = N.idw(N.grid(p, 50.0), p, 5, 15.0).withColumn("far", F.col("mean_dist") * 40)
    return r6(out.withColumn("quality", N.quality("far")).drop("far"))


@query("with " + _PTS + ", " + _cells("20") + ", " + _KNN + " select ix, iy, round(sum(z/(d+1e-9))/sum(1/(d+1e-9)),6) as z from k where rank<=5 and d<20 group by 1,2")
def r3_limited_idw(spark, sf_dir):
    p = _points(spark, sf_dir)
    return r6(N.idw(N.grid(p, 20.0), p, 5, 20.0, limit=20.0).select("ix", "iy", "z"))


@query("with " + _PTS + ", " + _cells("20") + """, j as (select ix, iy, z, p.x as px, p.y as py, sqrt(pow(p.x-c.x,2)+pow(p.y-c.y,2)) as d from cells c join pts p on p.x between c.x-30 and c.x+30 and p.y between c.y-30 and c.y+30 where sqrt(pow(p.x-c.x,2)+pow(p.y-c.y,2))<=30),
  w as (select *, exp(-pow(d-min(d) over (partition by ix, iy),2)/(2*15*15)) as w from j), m as (select ix, iy, sum(w*z)/sum(w) as m from w group by 1,2)
  select ix, iy, round(max(m),6) as z, round(sqrt(sum(w*pow(z-m,2))/sum(w)),5) as std, count(*) as n_pts, cast(sum(case when floor(px/20)=ix and floor(py/20)=iy then 1 else 0 end) as bigint) as n_in_cell from w join m using (ix, iy) group by 1,2""")
def r4_gaussian_grid(spark, sf_dir):
    p = _points(spark, sf_dir)
    return r6(N.gaussian(N.grid(p, 20.0), p, 20.0, 1.0, 15.0).withColumn("std", F.round("std", 5)))


@query("with " + _PTS + ", " + _cells("20") + """, j as (select ix, iy, mask, cast(round(exp(-(pow(p.x-c.x,2)+pow(p.y-c.y,2))/(2*15*15))*1e9) as bigint) as w from cells c join pts p on p.x between c.x-30 and c.x+30 and p.y between c.y-30 and c.y+30 where sqrt(pow(p.x-c.x,2)+pow(p.y-c.y,2))<=30 and mask<>0),
  v as (select ix, iy, mask, sum(w) as w from j group by 1,2,3), b as (select ix, iy, case when count(*)=1 then max(mask) end as mask, true as got from v where (ix, iy, w) in (select ix, iy, max(w) from v group by 1,2) group by 1,2)
  select ix, iy, case when got then mask else 0 end as mask from cells left join b using (ix, iy)""")
def r5_mask_grid(spark, sf_dir):
    p = _points(spark, sf_dir)
    return N.mask_raster(N.grid(p, 20.0), p, 20.0, 1.0, 15.0)
