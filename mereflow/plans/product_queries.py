"""Queries of scans, products, geolocation and whole jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from mereflow import fixtures as X
from mereflow import scratch
from mereflow.operators import geometry as G
from mereflow.operators import geoloc as O
from mereflow.operators import jobs as J
from mereflow.operators import labels as L
from mereflow.operators import neighbours as N
from mereflow.operators import products as R
from mereflow.operators import select as P
from mereflow.operators import spatial as Z
from mereflow.plans.grid_queries import _PTS, _cells, _points, _reach
from mereflow.plans.queries import KEY, KEYS, LAKE, n, r6

QUERIES: dict = {}
ORACLE: dict = {}


def query(sql=None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql.replace("{pixc}", X.PIXC_SQL).replace("{lakesp}", X.LAKESP_SQL).replace("{poly}", X.POLY_SQL)
        return f

    return put


#: Gaussian weights of the points around every cell of 20.
_GRID = "with " + _PTS + ", " + _cells("20") + """, j as (select ix, iy, z, sqrt(pow(p.x-c.x,2)+pow(p.y-c.y,2)) as d from cells c join pts p on p.x between c.x-30 and c.x+30 and p.y between c.y-30 and c.y+30 where sqrt(pow(p.x-c.x,2)+pow(p.y-c.y,2))<=30),
  w as (select *, exp(-pow(d-min(d) over (partition by ix, iy),2)/(2*15*15)) as w from j), m as (select ix, iy, sum(w*z)/sum(w) as m from w group by 1,2)"""

#: File names made of order rows: cycle, pass, tile, kind.
_FILES = """files as (select o_orderkey, printf('OUT_%s_%03d_%03d_%03d%s_20240101T%06d_20240102T%06d_PIC0_%02d.parquet', case o_orderkey%5 when 0 then 'Obs' when 1 then 'Prior' when 2 then 'Unassigned' when 3 then 'Edge' else 'PIXCVec' end,
   o_custkey%3+1, o_custkey%40+1, o_custkey%20+1, case when o_custkey%2=0 then 'L' else 'R' end, o_orderkey%240000, o_orderkey%240000, o_orderkey%100) as file, case o_orderkey%5 when 0 then 'Obs' when 1 then 'Prior' when 2 then 'Unassigned' when 3 then 'Edge' else 'PIXCVec' end as kind,
   cast(o_custkey%3+1 as int) as cycle, cast(o_custkey%40+1 as int) as pass, concat(cast(o_custkey%9+1 as varchar),'1;',cast(o_custkey%4+1 as varchar),'23') as basin_code, case when o_custkey%3=0 then 'EU;AS' else 'AF' end as continents,
   case when o_custkey%97=0 and o_orderkey%7=0 then 'b' else 'a' end as source, case when o_custkey%31=0 and o_orderkey%3=0 then 'y' else 'x' end as database, cast(o_custkey as double)/10 as lon_min, cast(o_custkey as double)/10+o_orderkey%7 as lon_max from orders)"""


def _files(spark, sf_dir):
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    kind = F.when(o % 5 == 0, "Obs").when(o % 5 == 1, "Prior").when(o % 5 == 2, "Unassigned").when(o % 5 == 3, "Edge").otherwise("PIXCVec")
    side = F.when(c % 2 == 0, "L").otherwise("R")
    name = F.format_string("OUT_%s_%03d_%03d_%03d%s_20240101T%06d_20240102T%06d_PIC0_%02d.parquet", kind, c % 3 + 1, c % 40 + 1, c % 20 + 1, side, o % 240000, o % 240000, o % 100)
    return X.table(spark, sf_dir, "orders").select("o_orderkey", name.alias("file"), kind.alias("kind"), (c % 3 + 1).cast("int").alias("cycle"), (c % 40 + 1).cast("int").alias("pass"), F.concat((c % 9 + 1).cast("string"), F.lit("1;"), (c % 4 + 1).cast("string"), F.lit("23")).alias("basin_code"), F.when(c % 3 == 0, "EU;AS").otherwise("AF").alias("continents"), F.when((c % 97 == 0) & (o % 7 == 0), "b").otherwise("a").alias("source"), F.when((c % 31 == 0) & (o % 3 == 0), "y").otherwise("x").alias("database"), (c / 10).alias("lon_min"), (c / 10 + o % 7).alias("lon_max"))


@query(f"with {{pixc}} select {KEYS}, longitude, latitude from pixc")
def s1_s2_s14_scan(spark, sf_dir):
    schema = "tile_number long, range_index int, azimuth_index int, longitude double, latitude double, classification int, cycle_number int, pass_number int"
    return R.read(spark, _stored(spark, sf_dir), schema, [*KEY, "longitude", "latitude"])


def _stored(spark, sf_dir):

    path = scratch.new_path(spark, "pixc")
    R.write(X.pixc(spark, sf_dir).select(*KEY, "cycle_number", "pass_number", "longitude", "latitude", "classification"), path, by=["cycle_number", "pass_number"])
    scratch.at_exit(spark, path)
    return path


@query(f"with {{pixc}}, e as (select *, min(illumination_time) over (partition by cycle_number) as t0 from pixc where azimuth_index=0 or azimuth_index=95) select {KEYS} from e where illumination_time-t0<=86400")
def s3_edge_scan(spark, sf_dir):
    return R.edge_scan(X.pixc(spark, sf_dir).where("azimuth_index in (0, 95)"), ["cycle_number"]).select(*KEY)


@query(f"with {{pixc}}, e as (select *, min(illumination_time) over (partition by pass_number, swath_side) as t0 from pixc where azimuth_index=0 or azimuth_index=95) select {KEYS}, pass_number, swath_side from e where illumination_time-t0<=72")
def s3_edge_window(spark, sf_dir):
    """Edge pixels of each swath within 72 seconds of its first one, which cuts the later tiles off."""
    return R.edge_scan(X.pixc(spark, sf_dir).where("azimuth_index in (0, 95)"), ["pass_number", "swath_side"], 0.02).select(*KEY, "pass_number", "swath_side")


@query("with {lakesp} select lake_id, cycle_number, pass_number, wse from lakesp where starts_with(lake_id,'10000001') and time>0 and wse>-1e10 and area_total>0")
def s4_s5_lakes_of_basin(spark, sf_dir):
    return R.lakes_of_basin(X.lakesp(spark, sf_dir), "10000001").select("lake_id", "cycle_number", "pass_number", "wse")


@query("with " + _FILES + " select o_orderkey, cycle, pass, concat(printf('%03d', (select o_custkey from orders o where o.o_orderkey=f.o_orderkey limit 1)%20+1), regexp_extract(file, '_[0-9]{3}([LR])_', 1)) as place, regexp_extract(file,'_([0-9]{8}T[0-9]{6})_',1) as start, concat('20240102T', printf('%06d', o_orderkey%240000)) as stop, 'PIC0' as crid, cast(o_orderkey%100 as int) as counter from files f")
def s7_name_fields(spark, sf_dir):
    f = _files(spark, sf_dir).select("o_orderkey", F.concat(F.lit("/a/b/"), "file").alias("path"))
    got = R.name_fields(F.col("path"))
    return f.select("o_orderkey", *(got[k].alias(k) for k in ("cycle", "pass", "place", "start", "stop", "crid", "counter")))


@query("with " + _FILES + " select cycle, pass from files where list_contains(string_split(continents,';'),'EU') and o_orderkey%3>0 group by 1,2 having count(distinct kind)=5")
def s8_complete_tiles(spark, sf_dir):
    return R.complete_tiles(_files(spark, sf_dir).where("o_orderkey % 3 > 0"), ["cycle", "pass"], "EU")


@query("with " + _FILES + ", b as (select unnest(['1','21','423','7']) as basin) select distinct file, basin from files, unnest(string_split(basin_code,';')) c(code), b where starts_with(code, basin)")
def s10_to_basins(spark, sf_dir):
    return R.to_basins(_files(spark, sf_dir), spark.createDataFrame([("1",), ("21",), ("423",), ("7",)], "basin string"))


@query("with " + _FILES + """, l as (select cycle, pass, min(file) as f from files where kind='Obs' and pass%7>0 group by 1,2), r as (select cycle, pass, min(file) as f from files where kind='Edge' and pass%5>0 group by 1,2)
  select coalesce(l.cycle,r.cycle) as cycle, coalesce(l.pass,r.pass) as pass, l.f as left_file, r.f as right_file from l full join r on l.cycle=r.cycle and l.pass=r.pass""")
def s11_pair_files(spark, sf_dir):
    f = _files(spark, sf_dir)
    one = lambda kind, m: f.where((F.col("kind") == kind) & (F.col("pass") % m > 0)).groupBy("cycle", "pass").agg(F.min("file").alias("file"))
    return R.pair_files(one("Obs", 7), one("Edge", 5), ["cycle", "pass"])


@query("with " + _FILES + " select distinct cycle, pass, left(basin_code,1) as continent from files")
def s12_work_units(spark, sf_dir):
    return _files(spark, sf_dir).select("cycle", "pass", F.substring("basin_code", 1, 1).alias("continent")).distinct()


@query(f"with {{pixc}} select {KEYS}, coalesce(round({n('height')},6),-999999999999.0) as height, coalesce(round({n('pole_tide')},6),-999999999999.0) as pole_tide, classification, coalesce(case when river=1 then reach_id end,'no_data') as reach_id, 'no_data' as obs_id from pixc")
def s13_x8_sink_rows(spark, sf_dir):
    p = X.pixc(spark, sf_dir).withColumn("reach_id", F.when(F.col("river") == 1, F.col("reach_id")))
    return R.for_sink(p, [*KEY, "height", "pole_tide", "classification", "reach_id", "obs_id"])


@query(f"with {{pixc}} select {KEYS}, round(pixel_area,6) as pixel_area, round(longitude,9) as lon, round(latitude,9) as lat from pixc where classification in (3,4,6,7)")
def s17_s18_point_export(spark, sf_dir):
    """The text holds the point's numbers to the last digit; the comparison reads them back."""
    out = R.export_points(X.pixc(spark, sf_dir), [*KEY, "pixel_area"], water_only=True)
    part = lambda k: F.round(F.regexp_extract("wkt", r"^POINT\((\S+) (\S+)\)$", k).cast("double"), 9)
    return out.select(*KEY, "pixel_area", part(1).alias("lon"), part(2).alias("lat"))


@query(_GRID + " select ix, iy, (ix+0.5e0)*20 as x, (iy+0.5e0)*20 as y, coalesce(round(max(m),6),-999999999999.0) as z, count(*) as n_pts from w join m using (ix, iy) group by 1,2")
def s17_grid_sink(spark, sf_dir):
    """The raster as it is read back from its table."""

    p, path = _points(spark, sf_dir), scratch.new_path(spark, "grid")
    cells = N.grid(p, 20.0)
    R.write_grid(N.gaussian(cells, p, 20.0, 1.0, 15.0).join(cells, ["ix", "iy"]), path, ["z", "n_pts"])
    scratch.at_exit(spark, path)
    return R.read(spark, path)


@query(f"""with {{pixc}}, v as (select {KEYS}, longitude+340 as longitude, latitude, height from pixc where river=0)
  select {KEYS}, round(case when v.longitude>180 then v.longitude-360 else v.longitude end,9) as longitude, round(v.height-p.pole_tide-p.load_tide_got-p.load_tide_fes-p.solid_earth_tide-p.geoid,6) as elevation,
  round(0.75/sin(incidence),6) as range_spacing, cast(round_even(illumination_time/3600,0) as bigint) as hour
  from pixc p join v using ({KEYS}) where classification>1 and not isnan(v.height) and not isinf(pole_tide)""")
def s6_floodplain_scan(spark, sf_dir):
    p = X.pixc(spark, sf_dir)
    vec = p.where("river = 0").withColumn("longitude", F.col("longitude") + 340)
    own = R.floodplain_scan(p.withColumn("pole_tide", F.nullif("pole_tide", F.lit(float("inf")))), vec, list(KEY), 0.75, 850000.0, 891000.0)
    return r6(own.select(*KEY, F.round("longitude", 9).alias("longitude"), "elevation", "range_spacing", "hour"))


@query("with " + _FILES + " select cycle, pass, min(regexp_extract(file,'_([0-9]{8}T[0-9]{6})_',1)) as start, max(regexp_extract(file,'_([0-9]{8}T[0-9]{6})_PIC',1)) as stop, min(lon_min) as lon_min, max(lon_max) as lon_max, string_agg(distinct file, ';' order by file) as inputs from files group by 1,2")
def s19_metadata(spark, sf_dir):
    f = _files(spark, sf_dir)
    got = R.name_fields(F.col("file"))
    return R.metadata(f.withColumns({"start": got["start"], "stop": got["stop"]}), ["cycle", "pass"])


@query("with " + _FILES + " select cycle, pass, count(distinct source) as sources, count(distinct database) as databases from files group by 1,2 having count(distinct source)>1 or count(distinct database)>1")
def s20_consistency(spark, sf_dir):
    return R.inconsistent(_files(spark, sf_dir), ["cycle", "pass"])


@query("with {lakesp} select lake_id, pass_number, wse from lakesp where pass_number%2=0 and starts_with(lake_id,'1') and obs_id<>'no_data' union all select lake_id, pass_number, wse from lakesp where pass_number%3=0 and starts_with(lake_id,'1') and obs_id<>'no_data'")
def u1_u2_u3_u6_merge(spark, sf_dir):
    own = X.lakesp(spark, sf_dir).select("lake_id", "pass_number", "wse", F.nullif("obs_id", F.lit("no_data")).alias("geometry"))
    return R.merge([own.where("pass_number % 2 = 0"), own.where("pass_number % 3 = 0")], "1", geometry="geometry").drop("geometry")


@query("with {pixc} select range_index as x, azimuth_index as y, case when isnan(height) then null else height end as z, tile_number-1 as source, not isnan(height) as valid from pixc where range_index between 18 and 62 and azimuth_index between 8 and 42")
def u7_combined_cloud(spark, sf_dir):
    p = X.pixc(spark, sf_dir).select(F.col("range_index").alias("x"), F.col("azimuth_index").alias("y"), F.col("height").alias("z"), "tile_number")
    return R.combined_cloud([p], (20, 60, 10, 40), 2).select("x", "y", F.nanvl("z", F.lit(None).cast("double")).alias("z"), (F.col("tile_number") - 1).alias("source"), "valid")


@query("with {pixc} select tile_number, range_index as x, azimuth_index as y, case when isnan(height) then null else height end as z, cast(case when classification=4 then 0 when classification=5 then 1 else 2 end as int) as source, not isnan(height) as valid from pixc where classification in (3,4,5,6) and range_index between 18 and 62 and azimuth_index between 8 and 42")
def u7_combined_clouds(spark, sf_dir):
    """Three clouds, of open, dark and other water, with the number of the cloud that each point is of."""
    p = X.pixc(spark, sf_dir)
    clouds = [p.where(c).select("tile_number", F.col("range_index").alias("x"), F.col("azimuth_index").alias("y"), F.col("height").alias("z")) for c in ("classification = 4", "classification = 5", "classification in (3, 6)")]
    return R.combined_cloud(clouds, (20, 60, 10, 40), 2).withColumn("z", F.nanvl("z", F.lit(None).cast("double")))


@query("""with {pixc}, r as (select tile_number, azimuth_index, range_index, case when tile_number%2=0 then row_number() over (partition by tile_number, azimuth_index order by range_index desc) else row_number() over (partition by tile_number, azimuth_index order by range_index) end as r from pixc),
  l as (select tile_number, azimuth_index, longitude, row_number() over (partition by tile_number, azimuth_index order by longitude, latitude) as r from pixc) select tile_number, azimuth_index, range_index, round(longitude,6) as longitude from r join l using (tile_number, azimuth_index, r)""")
def w1_pixel_lines(spark, sf_dir):
    return r6(R.pixel_lines(X.pixc(spark, sf_dir), ["tile_number"], F.col("tile_number") % 2 == 0))


@query(f"""with {{pixc}}, s as (select {KEYS}, longitude-lag(longitude) over w as dx, range_index-lag(range_index) over w as g from pixc window w as (partition by tile_number, azimuth_index order by range_index)) select {KEYS}, round(abs(dx),8) as spacing from s where g=1""")
def w9_row_spacing(spark, sf_dir):
    return r6(R.row_spacing(X.pixc(spark, sf_dir), ["tile_number"]), digits=8)


@query(f"with {{pixc}}, r as (select {KEYS}, lake, row_number() over (partition by tile_number, lake order by md5(concat_ws('_', tile_number, range_index, azimuth_index)), {KEYS}) as r from pixc) select {KEYS}, lake from r where r<=50")
def t6_sample_per_lake(spark, sf_dir):
    return R.sample_per_lake(X.pixc(spark, sf_dir), LAKE, 50, list(KEY)).select(*KEY, "lake")


_TRACK = "tr as (select tile_number, i as index, 600000000+tile_number*10+i*0.25 as time from (select distinct tile_number from pixc) t, range(0,6) r(i))"


def _track(spark, sf_dir):
    return X.pixc(spark, sf_dir).select("tile_number").distinct().withColumn("index", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(5).cast("long")))).withColumn("time", 600000000 + F.col("tile_number") * 10 + F.col("index") * 0.25)


@query(f"with {{pixc}}, " + _TRACK + f", j as (select {KEYS}, index, row_number() over (partition by {KEYS} order by round(abs(time-illumination_time),9), index%2, index) as r from pixc join tr using (tile_number)) select {KEYS}, index as sample from j where r=1")
def j1_nearest_sample(spark, sf_dir):
    return O.nearest_sample(X.pixc(spark, sf_dir).select(*KEY, "illumination_time"), _track(spark, sf_dir), ["tile_number"], 0.3).select(*KEY, "sample")


@query(f"with {{pixc}} select {KEYS}, round(pixel_area,3) as height_imp, 0e0 as range_change, 0e0 as doppler_change from pixc where not isnan(height)")
def d1_move_to_height(spark, sf_dir):
    """The new points have the target height, and the range and Doppler of the old ones."""
    from mereflow.functions.scalars import to_ecef

    p = X.pixc(spark, sf_dir).where("not isnan(height)").select(*KEY, "longitude", "latitude", "height", F.col("pixel_area").alias("target"))
    sx, sy, sz = to_ecef(F.col("longitude") + 0.4, F.col("latitude") + 0.001, F.lit(891000.0))
    p = p.withColumns({"sx": sx, "sy": sy, "sz": sz, "vx": F.lit(-5000.0), "vy": F.lit(1000.0), "vz": F.lit(5200.0)})
    out = O.move_to_height(p, "target")
    place = lambda a, b, c: to_ecef(F.col(a), F.col(b), F.col(c))
    new, old = place("lon_imp", "lat_imp", "height_imp"), place("longitude", "latitude", "height")
    s, v = [F.col(f"s{k}") for k in "xyz"], [F.col(f"v{k}") for k in "xyz"]
    dist = lambda q: F.sqrt(sum((a - b) ** 2 for a, b in zip(q, s)))
    dop = lambda q: sum((a - b) * c for a, b, c in zip(q, s, v)) / 7000
    return out.select(*KEY, F.round("height_imp", 3).alias("height_imp"), F.abs(F.round(dist(new) - dist(old), 2)).alias("range_change"), F.abs(F.round(dop(new) - dop(old), 2)).alias("doppler_change"))


@query(f"with {{pixc}} select {KEYS}, round(3+0.2e0*range_index-0.01e0*range_index*range_index+0.3e0*azimuth_index+0.002e0*range_index*azimuth_index,4) as height_model from pixc")
def a28_polynomial_surface(spark, sf_dir):
    x, y = F.col("range_index"), F.col("azimuth_index")
    p = X.pixc(spark, sf_dir).select(*KEY, "lake", x.cast("double").alias("x"), y.cast("double").alias("y"), (3 + 0.2 * x - 0.01 * x * x + 0.3 * y + 0.002 * x * y).alias("height"))
    return r6(O.polynomial_surface(p, LAKE).select(*KEY, "height_model"), digits=4)


@query("""with {pixc}, p as (select tile_number, lake, cast(range_index as double) as x, cast(azimuth_index as double) as y, height, range_index, azimuth_index from pixc), c as (select tile_number, lake, avg(x) as xc, avg(y) as yc from p group by 1,2),
  j as (select *, greatest(abs(x-xc-i*6.0),abs(y-yc-k*6.0)) as f from p join c using (tile_number, lake), range(-4,5) a(i), range(-4,5) b(k)),
  g as (select tile_number, lake, i as gx, k as gy, avg(case when not isnan(height) then height end) as h, avg(case when f<3 then range_index end) as r, avg(case when f<3 then azimuth_index end) as a from j where f<5 group by 1,2,3,4)
  select tile_number, lake, gx, gy, round(h,8) as height, round(r,8) as range_index, round(a,8) as azimuth_index from g where r is not null""")
def a29_grid_means(spark, sf_dir):
    p = X.pixc(spark, sf_dir).select(*KEY, "lake", F.col("range_index").cast("double").alias("x"), F.col("azimuth_index").cast("double").alias("y"), "height")
    return r6(O.grid_means(p, LAKE, 6.0, 10.0), digits=8)


@query("""with {pixc}, m as (select tile_number, lake, sum(case when not isnan(height) then height/(height_std*height_std) end)/sum(case when not isnan(height) then 1/(height_std*height_std) end) as m from pixc group by 1,2)
  select tile_number, range_index, azimuth_index, round(m,7) as height_target from pixc join m using (tile_number, lake)""")
def d2_height_model(spark, sf_dir):
    p = X.pixc(spark, sf_dir).withColumns({"x": F.col("range_index").cast("double"), "y": F.col("azimuth_index").cast("double")})
    return r6(O.height_model(p, LAKE).select(*KEY, "height_target"), digits=7)


@query("""with {pixc}, p as (select tile_number, lake, cast(range_index as double) as x, cast(azimuth_index as double) as y, height, range_index, azimuth_index, height_std, pixel_area from pixc), z as (select tile_number, lake, sum(pixel_area)>=16000 as big, avg(x) as xc, avg(y) as yc,
    sum(case when not isnan(height) then height/(height_std*height_std) end)/sum(case when not isnan(height) then 1/(height_std*height_std) end) as m from p group by 1,2),
  j as (select *, greatest(abs(x-xc-i*6.0),abs(y-yc-k*6.0)) as f from p join z using (tile_number, lake), range(-4,5) a(i), range(-4,5) b(k) where big),
  g as (select * from (select tile_number, lake, i, k, avg(case when not isnan(height) then height end) as h, avg(case when f<3 then range_index end) as r, avg(case when f<3 then azimuth_index end) as a from j where f<5 group by 1,2,3,4) where r is not null and h is not null),
  n as (select tile_number, lake, range_index, azimuth_index, arg_min(h, struct_pack(d:=(x-r)*(x-r)+(y-a)*(y-a), h:=h)) as h from p join g using (tile_number, lake) group by 1,2,3,4)
  select tile_number, range_index, azimuth_index, big, case when big then round(n.h,8) else round(m,8) end as height_target, case when big then round(3+0.2e0*range_index-0.01e0*range_index*range_index+0.3e0*azimuth_index,4) end as surface
  from p join z using (tile_number, lake) left join n using (tile_number, lake, range_index, azimuth_index)""")
def d2_a29_height_models(spark, sf_dir):
    """Means of small lakes and grid heights of big ones, and beside them the surface of big lakes whose heights are a polynomial."""
    from mereflow import scratch

    # every step of both models reads the pixels, which are made once
    p = scratch.save(X.pixc(spark, sf_dir).select(*KEY, "lake", "height", "height_std", "pixel_area"), "model-pixels")
    p = p.withColumns({"x": F.col("range_index").cast("double"), "y": F.col("azimuth_index").cast("double")})
    big = p.groupBy(*LAKE).agg((F.sum("pixel_area") >= 16000).alias("big"))
    grid = O.height_model(p, LAKE, big=16000.0, model="grid", spacing=6.0, resolution=10.0)
    exact = p.withColumn("height", 3 + 0.2 * F.col("x") - 0.01 * F.col("x") * F.col("x") + 0.3 * F.col("y"))
    poly = O.height_model(exact, LAKE, big=16000.0).select(*KEY, F.col("height_target").alias("surface"))
    out = grid.join(big, LAKE).join(poly, list(KEY))
    return out.select(*KEY, "big", F.round("height_target", 8).alias("height_target"), F.when(F.col("big"), F.round("surface", 4)).alias("surface"))


_NODES = """nd as (select reach_id, node_id, 100.0*node_id as s, case when node_id%5=4 then null else 10+0.5*node_id+(node_id%3)*0.1 end as hn, 20+0.01*node_id as ge, 0.01 as lo, 0.1 as so, 0.001*node_id as po from pixc where node_id<>6 group by 1,2),
  ft as (select reach_id, regr_slope(hn,node_id) as sl, regr_intercept(hn,node_id) as ic from nd group by 1 having count(hn)>=2),
  ne as (select nd.*, sl*node_id+ic+ge+lo+so+po as h from nd left join ft using (reach_id)),
  nn as (select *, lag(node_id) over w as pn, lag(s) over w as sp, lag(h) over w as hp, lead(node_id) over w as nx, lead(s) over w as sn, lead(h) over w as hx from ne window w as (partition by reach_id order by node_id)),
  j as (select p.tile_number, p.range_index, p.azimuth_index, p.height, n.h, n.s, 100.0*p.node_id+p.range_index%41-20 as al, case when pn=n.node_id-1 then sp end as sp, case when pn=n.node_id-1 then hp end as hp, case when nx=n.node_id+1 then sn end as sn, case when nx=n.node_id+1 then hx end as hx
    from pixc p left join nn n using (reach_id, node_id) where p.river=1 and not isnan(p.height))"""


@query("with {pixc}, " + _NODES + f""" select {KEYS}, round(coalesce(case when hp is not null and hx is not null then case when s<al then (h*(sn-al)+hx*(al-s))/(sn-s) else (hp*(s-al)+h*(al-sp))/(s-sp) end end, h, height)+1e-5,3) as height_imp, abs(coalesce(case when hp is not null and hx is not null then case when s<al then (h*(sn-al)+hx*(al-s))/(sn-s) else (hp*(s-al)+h*(al-sp))/(s-sp) end end, h, height)-height)>4e-6 as moved, 0e0 as range_change, 0e0 as doppler_change from j""")
def d3_river_geolocation(spark, sf_dir):
    """River pixels at their nodes' fitted heights on the ellipsoid, range and Doppler kept; those that keep their height are not ``moved``. Half millimetres, to a hundredth of one, go up."""
    from mereflow.functions.scalars import to_ecef

    p = X.pixc(spark, sf_dir)
    k = F.col("node_id")
    nodes = p.where("node_id <> 6").select("reach_id", "node_id").distinct().select("reach_id", "node_id", (k * 100.0).alias("s"), F.when(k % 5 != 4, 10 + 0.5 * k + (k % 3) * 0.1).alias("h_n_ave"), (20 + 0.01 * k).alias("geoid_hght"), F.lit(0.01).alias("load_tidef"), F.lit(0.1).alias("solid_tide"), (0.001 * k).alias("pole_tide"))
    sx, sy, sz = to_ecef(F.col("longitude") + 0.4, F.col("latitude") + 0.001, F.lit(891000.0))
    px = p.where("river = 1 and not isnan(height)").select(*KEY, "reach_id", "node_id", (k * 100.0 + F.col("range_index") % 41 - 20).alias("along_reach"), "longitude", "latitude", "height")
    px = px.withColumns({"sx": sx, "sy": sy, "sz": sz, "vx": F.lit(-5000.0), "vy": F.lit(1000.0), "vz": F.lit(5200.0)})
    out = O.river_geolocation(px, nodes)
    place = lambda a, b, c: to_ecef(F.col(a), F.col(b), F.col(c))
    new, old = place("lon_imp", "lat_imp", "height_imp"), place("longitude", "latitude", "height")
    s, v = [F.col(f"s{k}") for k in "xyz"], [F.col(f"v{k}") for k in "xyz"]
    dist = lambda q: F.sqrt(sum((a - b) ** 2 for a, b in zip(q, s)))
    dop = lambda q: sum((a - b) * c for a, b, c in zip(q, s, v)) / 7000
    # on the way to the ellipsoid and back a place changes by less than a billionth of a degree
    moved = (F.abs(F.col("lon_imp") - F.col("longitude")) + F.abs(F.col("lat_imp") - F.col("latitude"))) > 1e-9
    return out.select(*KEY, F.round(F.col("height_imp") + 1e-5, 3).alias("height_imp"), moved.alias("moved"), F.abs(F.round(dist(new) - dist(old), 2)).alias("range_change"), F.abs(F.round(dop(new) - dop(old), 2)).alias("doppler_change"))


@query("with {pixc}, t as (select distinct tile_number from pixc) select tile_number, k as point, round(5+3*(k*31/9.0)+0.5*pow(k*31/9.0,2),5) as lon from t, range(0,10) r(k)")
def a30_quadratic_resampling(spark, sf_dir):
    i = F.col("index")
    s = X.pixc(spark, sf_dir).select("tile_number").distinct().withColumn("index", F.explode(F.sequence(F.lit(0), F.lit(31)))).withColumn("lon", 5 + 3 * i + 0.5 * i * i)
    return r6(O.quadratic_resampling(s, ["tile_number"], ["lon"], 10), digits=5)


@query("""with t as (select k as pass_number, i, k*2.0 as lon, i*1.0 as lat from range(0,20) a(k), range(0,40) b(i)), a as (select s_suppkey as area_id, cast(s_suppkey*17%40 as double) as x0, cast(s_suppkey*17%40 as double)+1 as x1, cast(s_suppkey*29%40 as double) as y0, cast(s_suppkey*29%40 as double)+2 as y1 from supplier)
  select distinct pass_number, area_id, s as side from t, a, (select unnest(['L','R']) as s) where i<39 and lat<=y1 and lat+1>=y0 and (case when s='L' then lon-0.6 else lon+0.1 end)<=x1 and (case when s='L' then lon-0.1 else lon+0.6 end)>=x0""")
def j22_passes_over(spark, sf_dir):
    track = spark.range(20).select(F.col("id").alias("pass_number"), F.explode(F.sequence(F.lit(0), F.lit(39))).alias("index")).withColumns({"lon": F.col("pass_number") * 2.0, "lat": F.col("index") * 1.0})
    k = F.col("s_suppkey")
    areas = X.table(spark, sf_dir, "supplier").select(k.alias("area_id"), (k * 17 % 40).cast("double").alias("x0"), ((k * 17 % 40) + 1).cast("double").alias("x1"), (k * 29 % 40).cast("double").alias("y0"), ((k * 29 % 40) + 2).cast("double").alias("y1"))
    return O.passes_over(track, areas, 0.6, 0.1)


_H = "case when isinf(pole_tide) then null else height-geoid-solid_earth_tide-pole_tide-load_tide_fes end"
_WSE = f"sum(case when classification in (3,4,6,7) then ({_H})/(height_std*height_std) end)/sum(case when classification in (3,4,6,7) and not isinf(pole_tide) then 1/(height_std*height_std) end)"
_AREA = "sum(case when classification in (2,3) then pixel_area*water_frac else pixel_area end)/1e6"
_TILE = _reach("not isnan(height) and classification in (3,4,5,6,7)", "abs(q.a-p.a)+abs(q.r-p.r)=1") + """, x as (select t, max(a) as top from p group by 1),
  f as (select t, label, max(case when a=0 then 1 else 0 end) as b, max(case when a=top then 1 else 0 end) as tp from p join l using (id) join x using (t) group by 1,2),
  px as (select c.*, p.id, l.label from p join l using (id) join pixc c on c.tile_number=p.t and c.range_index=p.r and c.azimuth_index=p.a)"""
_TILE_LINKS = """lk as (select label, lake_id, cast(count(*) as double) as area, count(*)/max(k) as overlap from own join (select label, count(*)*1e0 as k from own group by 1) using (label) join poly on range_index+0.5>=x0 and range_index+0.5<x1 and azimuth_index+0.5>=y0 and azimuth_index+0.5<y1 group by 1,2 having count(*)/max(k)>0.02)"""


def _placed(spark, sf_dir):
    return X.pixc(spark, sf_dir).withColumns({"x": F.col("range_index") + 0.5, "y": F.col("azimuth_index") + 0.5})


def _listed(c):
    return F.array_join(c, ";")


@query(_TILE.replace("{pixc}", "{pixc}, {poly}") + f""", sz as (select t, label from px join f using (label) where b=0 and tp=0 group by 1,2 having sum(case when classification in (4,5) then pixel_area end)/1e6>=0.0001 and min(range_index)<max(range_index) and min(azimuth_index)<max(azimuth_index)),
  own as (select px.* from px join sz using (label)), {_TILE_LINKS},
  ob as (select label, count(*) as n_pix, {_WSE} as wse, {_AREA} as area_total, sum(height/(height_std*height_std))/sum(1/(height_std*height_std)) as moved_to from own group by 1),
  li as (select label, string_agg(lake_id, ';' order by overlap desc, lake_id) as links from lk group by 1),
  pr as (select lake_id, string_agg(cast(label as varchar), ';' order by area desc, cast(label as varchar)) as links from lk group by 1)
  select case when links is null then 'Unassigned' else 'Obs' end as kind, cast(label as varchar) as id, links, n_pix, round(wse,6) as wse, round(area_total,9) as area_total, round(moved_to,6) as moved_to from ob left join li using (label)
  union all select 'Prior', lake_id, links, null, null, null, null from poly left join pr using (lake_id)""")
def d6_tile_product(spark, sf_dir):
    """Observed, unassigned and prior lakes of the tile job in one table, with the height that their pixels are moved to."""
    job = R.tile_product(_placed(spark, sf_dir), X.box_rings(X.poly(spark, sf_dir)), 0.0001)
    moved = job["vec"].groupBy("label").agg(F.max("height_target").alias("moved_to"))
    row = lambda df, kind, links: df.join(moved, "label").select(F.lit(kind).alias("kind"), F.col("obs_id").alias("id"), links.alias("links"), "n_pix", F.round("wse", 6).alias("wse"), F.round("area_total", 9).alias("area_total"), F.round("moved_to", 6).alias("moved_to"))
    lakes = row(job["obs"], "Obs", _listed("lake_ids")).unionByName(row(job["unassigned"], "Unassigned", F.lit(None).cast("string")))
    prior = job["prior"].select(F.lit("Prior").alias("kind"), F.col("lake_id").alias("id"), _listed("obs_ids").alias("links"))
    return lakes.unionByName(prior, allowMissingColumns=True)


@query(_TILE.replace("{pixc}", "{pixc}, {poly}") + f""", z as (select px.*, range_index+3*(tile_number-1) as rr, (select max(azimuth_index) from px q join f g using (label) where (g.b=1 or g.tp=1) and q.tile_number=px.tile_number) as top from px join f using (label) where b=1 or tp=1),
  k as (select distinct u.label as i, v.label as j from z u join z v on v.tile_number=u.tile_number+1 and u.azimuth_index=u.top and v.azimuth_index=0 and u.rr=v.rr), kk as (select i, j from k union select j, i from k),
  m(i, j) as (select distinct label, label from z union select m.i, kk.j from m join kk on m.j=kk.i), mg as (select i as old, min(j) as merged from m group by 1),
  own as (select z.* exclude (label), merged as label from z join mg on old=label), {_TILE_LINKS},
  ob as (select label, count(*) as n_pix, {_WSE} as wse, {_AREA} as area_total from own group by 1),
  fu as (select lake_id, sum(n_pix) as n_pix, case when count(*)=count(wse) then sum(wse*area_total)/sum(area_total) end as wse, sum(area_total) as area_total, string_agg(cast(label as varchar), ';' order by overlap desc, cast(label as varchar)) as links from ob join lk using (label) group by 1)
  select 'Prior' as kind, lake_id as id, links, cast(n_pix as bigint) as n_pix, round(wse,6) as wse, round(area_total,9) as area_total from fu
  union all select 'Unassigned', cast(label as varchar), null, n_pix, round(wse,6), round(area_total,9) from ob where label not in (select label from lk)""")
def d7_pass_product(spark, sf_dir):
    """Fused prior lakes and unassigned lakes of the pass job."""
    p = _placed(spark, sf_dir)
    prior = X.box_rings(X.poly(spark, sf_dir))
    edge = R.tile_product(p, prior)["edge"].withColumn("pass_number", F.lit(1))
    t = F.col("tile_number")
    meta = p.select("tile_number").distinct().select(F.lit(1).alias("pass_number"), t, (800000 + t * 2.3).alias("near_range"), F.lit(0.75).alias("nominal_slant_range_spacing"), F.lit(96).alias("interferogram_size_azimuth"))
    job = R.pass_product(edge, meta, ["pass_number"], prior)
    row = lambda df, kind, key, links: df.select(F.lit(kind).alias("kind"), F.col(key).alias("id"), links.alias("links"), "n_pix", F.round("wse", 6).alias("wse"), F.round("area_total", 9).alias("area_total"))
    return row(job["prior"], "Prior", "lake_id", F.col("obs_id")).unionByName(row(job["unassigned"], "Unassigned", "obs_id", F.lit(None).cast("string")))


#: Greedy disjoint set of regions: rk (id, k by size), mt (id, the ranks of the regions that it meets).
_GREEDY = """gr(k, taken) as (select cast(0 as bigint), cast([] as bigint[]) union all select g.k+1, case when coalesce(list_has_any(g.taken, mt.bs), false) then g.taken else list_append(g.taken, rk.k) end from gr g join rk on rk.k=g.k+1 left join mt on mt.id=rk.id),
  ch as (select id from rk where list_contains((select taken from gr order by k desc limit 1), k))"""
#: Cells (ix, iy) between highest and lowest water, from rc (id, ix, iy).
_BETWEEN = """sz as materialized (select id, count(*)*1e0 as area from rc group by 1), rk as materialized (select id, row_number() over (order by area, id) as k from sz),
  sh as (select a.id as a, b.id as b, count(*) as n from rc a join rc b using (ix, iy) where a.id<>b.id group by 1,2), mt as materialized (select a as id, list(rk.k) as bs from sh join sz x on x.id=a join sz y on y.id=b join rk on rk.id=b where n>0.001*greatest(x.area,y.area) group by 1), """ + _GREEDY + """,
  hi as (select distinct ix+i as ix, iy+j as iy from rc, range(-1,2) a(i), range(-1,2) b(j)), lw as (select distinct ix+i as ix, iy+j as iy from rc join ch using (id), range(-1,2) a(i), range(-1,2) b(j)),
  er as (select ix+i as ix, iy+j as iy from lw, range(-1,2) a(i), range(-1,2) b(j) group by 1,2 having count(*)=9), bw as (select ix, iy from hi except select ix, iy from er)"""


@query("with recursive {poly}, rc as materialized (select lake_id as id, cast(i as bigint) as ix, cast(j as bigint) as iy from poly, range(0,120) a(i), range(0,120) b(j) where i>=x0 and i<x1 and j>=y0 and j<y1), " + _BETWEEN + " select ix, iy from bw")
def g8_extent_between(spark, sf_dir):
    steps = lambda a, b: F.explode(F.sequence(F.col(a).cast("long"), F.col(b).cast("long") - 1))
    cells = X.poly(spark, sf_dir).select(F.col("lake_id").alias("id"), "y0", "y1", steps("x0", "x1").alias("ix")).select("id", "ix", steps("y0", "y1").alias("iy"))
    return G.extent_between(cells, 1)


@query("""with {pixc}, c as (select tile_number*100+lake as id, max(case when isnan(height) then 0 else height end) over (partition by tile_number, lake) as height, range_index as ix, azimuth_index as iy, classification from pixc),
  s as (select * from (values (0, 1, 0.5e0), (1, 3, 2e0)) v(step, d, ch)) select distinct cast(step as int) as step, id, round(height+ch,6) as height, ix+i as ix, iy+j as iy from c, s, range(-3,4) a(i), range(-3,4) b(j) where classification=4 and abs(i)<=d and abs(j)<=d""")
def g9_expand_water(spark, sf_dir):
    from pyspark.sql import Window

    p = X.pixc(spark, sf_dir).withColumn("h", F.max(F.nanvl("height", F.lit(0.0))).over(Window.partitionBy(*LAKE)))
    c = p.where("classification = 4").select((F.col("tile_number") * 100 + F.col("lake")).alias("id"), F.col("h").alias("height"), F.col("range_index").alias("ix"), F.col("azimuth_index").alias("iy"))
    return r6(G.expand_water(c, [(1, 0.5), (3, 2.0)]))


_SMALL = """e as materialized (select a.id as i, b.id as j from pts a join pts b on b.x between a.x-9 and a.x+9 and b.y between a.y-9 and a.y+9 where sqrt(pow(a.x-b.x,2)+pow(a.y-b.y,2)+pow(a.z-b.z,2))<=9),
  w(i, j) as (select id, id from pts union select w.i, e.j from w join e on w.j=e.i), l as (select i as id, min(j) as root from w group by 1), s as (select root from l group by 1 having count(*)>=3), p1 as materialized (select pts.* from pts join l using (id) join s using (root))"""


@query("with recursive " + _PTS + ", " + _SMALL + """, k as (select a.id, sqrt(pow(a.x-b.x,2)+pow(a.y-b.y,2)) as d, row_number() over (partition by a.id order by sqrt(pow(a.x-b.x,2)+pow(a.y-b.y,2)), b.id) as r from p1 a join p1 b on b.x between a.x-250 and a.x+250 and b.y between a.y-250 and a.y+250),
  me as (select id, sum(d)/4 as m from k where r<=5 group by 1), p2 as materialized (select p1.* from p1 join me using (id) where m<=(select avg(m)+1.0*stddev_pop(m) from me)), """ + _cells("20").replace("from pts", "from p2") + """,
  j as (select ix, iy, z, p.x as px, p.y as py, sqrt(pow(p.x-c.x,2)+pow(p.y-c.y,2)) as d from cells c join p2 p on p.x between c.x-30 and c.x+30 and p.y between c.y-30 and c.y+30 where sqrt(pow(p.x-c.x,2)+pow(p.y-c.y,2))<=30),
  ww as (select *, exp(-pow(d-min(d) over (partition by ix, iy),2)/(2*15*15)) as w from j), m as (select ix, iy, sum(w*z)/sum(w) as m from ww group by 1,2)
  select ix, iy, round(max(m),6) as z, round(sqrt(sum(w*pow(z-m,2))/sum(w)),5) as std, count(*) as n_pts, cast(sum(case when floor(px/20)=ix and floor(py/20)=iy then 1 else 0 end) as bigint) as n_in_cell from ww join m using (ix, iy) group by 1,2""")
def r8_filtered_raster(spark, sf_dir):
    out = N.filtered_raster(_points(spark, sf_dir), 20.0, 9.0, 3, 4, 1.0, 1.0, 15.0)
    return r6(out.withColumn("std", F.round("std", 5)))


_FLOOD = f"""with recursive {{pixc}}, sc as (select *, height-pole_tide-load_tide_got-load_tide_fes-solid_earth_tide-geoid as z from pixc where classification in (3,4) and not isnan(height)),
  li as (select tile_number, azimuth_index, min(case when cross_track>=20000 then range_index end) as fk, max(case when cross_track<20000 then range_index end) as lr from sc group by 1,2), mx as (select tile_number, max(azimuth_index) as am, max(range_index) as rm from sc group by 1),
  p as materialized (select s.tile_number as t, s.azimuth_index as a, s.range_index as r, s.tile_number*1099511627776+s.azimuth_index*1048576+s.range_index as id, pixel_area, z from sc s join li using (tile_number, azimuth_index) join mx using (tile_number)
    where cross_track>=20000 and azimuth_index not in (0,am) and range_index<>rm and not (coalesce(fk=lr+1,false) and range_index=fk)),
  e as materialized (select p.id as i, q.id as j from p join p q on q.t=p.t and q.a between p.a-1 and p.a+1 and q.r between p.r-1 and p.r+1 and q.id<>p.id),
  w(i, j) as (select id, id from p union select w.i, e.j from w join e on w.j=e.i), l as (select i as id, min(j) as label from w group by 1),
  lg as (select label from p join l using (id) group by 1 having sum(pixel_area)>400), rg as materialized (select p.*, label, r+t*100e0 as x, a*1e0 as y from p join l using (id) join lg using (label)),
  ar as (select g.id, count(q.id) as n from rg g left join rg q on q.label=g.label and q.t=g.t and q.a between g.a-1 and g.a+1 and q.r between g.r-1 and g.r+1 and abs(q.a-g.a)+abs(q.r-g.r)=1 group by 1),
  pts as materialized (select rg.id, x, y, z from rg join ar using (id) where n<4 and not isinf(z)),
  rc as materialized (select distinct label as id, cast(floor(x/4) as bigint) as ix, cast(floor(y/4) as bigint) as iy from rg), {_BETWEEN}, {_cells("4")},
  kn as (select ix, iy, p.z, sqrt(pow(p.x-c.x,2)+pow(p.y-c.y,2)) as d, row_number() over (partition by ix, iy order by sqrt(pow(p.x-c.x,2)+pow(p.y-c.y,2)), p.id) as rank from cells c join bw using (ix, iy) join pts p on p.x between c.x-100 and c.x+100 and p.y between c.y-100 and c.y+100),
  gg as (select ix, iy, sum(z/(d+1e-9))/sum(1/(d+1e-9)) as z, min(d) as mi, avg(d) as me, abs(stddev_pop(z)/avg(z)) as re from kn where rank<=5 group by 1,2)
  select ix, iy, round(z,6) as z, round(mi,6) as min_dist, round(me,6) as mean_dist, round(re,6) as z_rel, case when re>0.3 and me>500 then 4 when me>500 then 3 when re>0.1 then 2 else 1 end as quality from gg"""


@query(_FLOOD)
def d9_r7_floodplain(spark, sf_dir):
    p = X.pixc(spark, sf_dir)
    scan = R.floodplain_scan(p, p.select(*KEY, "longitude", "latitude", "height"), list(KEY), 0.75, 850000.0, 891000.0)
    own = scan.withColumns({"x": F.col("range_index") + F.col("tile_number") * 100.0, "y": F.col("azimuth_index").cast("double"), "z": F.col("elevation")})
    return r6(R.floodplain(own, 4.0, near=20000.0, min_area=400.0, classes=(3, 4)))


#: Boxes of orders, and a triangle that cuts some of them.
_BOXES = "ob as (select cast(o_orderkey as varchar(20)) as lake_id, cast(o_orderkey*7919%1000 as double) as x0, cast(o_orderkey*104729%1000 as double) as y0, o_custkey%7+1.5 as w, o_custkey%11+0.5 as h from orders)"
_AREA_RING = [(100.0, 100.0), (500.0, 100.0), (100.0, 400.0)]


# The whole jobs -------------------------------------------------------------------------------

_GOOD = "not isnan(height) and classification in (3,4,5,6,7) and not (river=1 and right(reach_id,1)<>'3') and geolocation_qual&8388608=0"
_JOB = _TILE.replace("not isnan(height) and classification in (3,4,5,6,7)", _GOOD).replace("{pixc}", "{pixc}, {poly}")
#: Prior lakes with names and references, from the boxes.
_PLD = """pd as (select poly.*, case when right(lake_id,1)='3' then null else concat('n', right(lake_id,3)) end as names, 20.0+cast(right(lake_id,2) as int)%7 as ref_wse, (1+cast(right(lake_id,2) as int)%5)/1000.0 as ref_area from poly)"""
#: Links, pixel lakes, attributes and storage of the objects ``own`` (label, oid), in scopes ``sc``.
_CHAIN = _PLD + ", " + _TILE_LINKS + f""", lo as (select lk.*, o.oid, o.sc from lk join (select distinct label, oid, sc from own) o using (label)),
  c as (select label, count(*) as k, min(lake_id) as single from lk group by 1),
  pin as (select own.id, min(lake_id) as lake from own join lk using (label) join pd using (lake_id) where range_index+0.5>=x0 and range_index+0.5<x1 and azimuth_index+0.5>=y0 and azimuth_index+0.5<y1 group by 1),
  v as (select lake_id, x0 as vx, y0 as vy from poly union all select lake_id, x1, y0 from poly union all select lake_id, x1, y1 from poly union all select lake_id, x0, y1 from poly),
  ne as (select own.id, arg_min(lake_id, struct_pack(d:=pow(range_index+0.5-vx,2)+pow(azimuth_index+0.5-vy,2), l:=lake_id)) as lake from own join lk using (label) join v using (lake_id) group by 1),
  pl as (select own.*, case when k=1 then single else coalesce(pin.lake, ne.lake) end as lake_id from own join c using (label) left join pin using (id) left join ne using (id)),
  pa as (select sc, lake_id, count(*) as n_pix, max(partial_f) as partial_f, {_WSE} as wse, {_AREA} as area_total from pl group by 1,2),
  st as (select sc, lake_id, (wse-ref_wse)/2*(ref_area+area_total)/1000 as ds_l, (wse-ref_wse)/3*(ref_area+area_total+sqrt(ref_area*area_total))/1000 as ds_q from pa join pd using (lake_id) where partial_f=0 and wse is not null and area_total is not null),
  so as (select oid, sum(pt*ds_l) as ds_l, sum(pt*ds_q) as ds_q from (select *, area/sum(area) over (partition by sc, lake_id) as pt from lo) join st using (sc, lake_id) group by 1),
  ce as (select distinct a.label from own a join own b on b.label=a.label and b.gx=a.gx+1 and b.gy=a.gy join own d on d.label=a.label and d.gx=a.gx and d.gy=a.gy+1 join own e on e.label=a.label and e.gx=a.gx+1 and e.gy=a.gy+1),
  bd as (select own.label, count(*) as shore from own join ce using (label) where not divided and (select count(*) from own z where z.label=own.label and abs(z.gx-own.gx)+abs(z.gy-own.gy)=1)<4 group by 1),
  ob as (select label, oid, max(partial_f) as partial_f, count(*) as n_pix, {_WSE} as wse, {_AREA} as area_total, sum(height/(height_std*height_std))/sum(1/(height_std*height_std)) as height_imp from own group by 1,2),
  li as (select oid, string_agg(lake_id, ';' order by overlap desc, lake_id) as links, string_agg(names, ';' order by overlap desc, names) as lake_name from lo join pd using (lake_id) group by 1),
  pr as (select sc, lake_id, string_agg(oid, ';' order by area desc, oid) as links from lo group by 1,2)"""
_JOB_ROWS = """ select case when links is null then 'Unassigned' else 'Obs' end as kind, oid as id, links, lake_name, partial_f, n_pix, round(wse,6) as wse, round(area_total,9) as area_total, round(height_imp,3) as height_imp, shore, round(ds_l,9) as ds_l, round(ds_q,9) as ds_q
    from ob left join li using (oid) left join bd using (label) left join so using (oid)
  union all select 'Prior', concat(cast(sc as varchar), '-', lake_id), links, null, partial_f, n_pix, round(wse,6), round(area_total,9), null, null, round(ds_l,9), round(ds_q,9) from pa left join pr using (sc, lake_id) left join st using (sc, lake_id)
  union all select 'Unobserved', lake_id, null, null, null, null, null, null, null, null, null, null from poly where lake_id not in (select lake_id from lk)"""


def _sensed(spark, sf_dir):
    from mereflow.functions.scalars import to_ecef

    sx, sy, sz = to_ecef(F.col("longitude") + 0.4, F.col("latitude") + 0.001, F.lit(891000.0))
    return _placed(spark, sf_dir).drop("lake").withColumns({"sx": sx, "sy": sy, "sz": sz, "vx": F.lit(-5000.0), "vy": F.lit(1000.0), "vz": F.lit(5200.0)})


def _references(spark, sf_dir):
    two, none = F.substring("lake_id", -2, 2).cast("int"), F.lit(None).cast("double")
    names = F.when(~F.col("lake_id").endswith("3"), F.concat(F.lit("n"), F.substring("lake_id", -3, 3)))
    return X.box_rings(X.poly(spark, sf_dir)).withColumns({"names": names, "ice_clim_flag": F.lit(1), "ice_dyn_flag": F.lit(0), "res_id": F.lit(0), "ref_wse": 20.0 + two % 7, "ref_wse_u": F.lit(0.1), "ref_area": (1 + two % 5) / 1000.0, "ref_area_u": F.lit(0.0001), "ds_t0": none})


def _tile_job(spark, sf_dir):
    p = _sensed(spark, sf_dir)
    return J.tile_job(p, p.where("river = 1").select(*KEY, "reach_id"), _references(spark, sf_dir), {"geolocation_qual": 1 << 23}, 0.0001, 96)


def _job_rows(job, scope):
    digits = lambda c, d: F.round(c, d).alias(c)
    none = lambda t: F.lit(None).cast(t)
    shore = F.when(F.col("contour") & ~F.col("divided"), F.size(F.array_distinct(F.flatten(F.transform("rings", lambda r: F.slice(r, 1, F.size(r) - 1)))))).cast("long")
    obs = lambda df, kind: df.select(F.lit(kind).alias("kind"), F.col("obs_id").alias("id"), _listed("lake_ids").alias("links"), F.when(F.col("lake_ids").isNotNull(), F.col("lake_name")).alias("lake_name"), "partial_f", "n_pix", digits("wse", 6), digits("area_total", 9), digits("height_imp", 3), shore.alias("shore"), digits("ds_l", 9), digits("ds_q", 9))
    prior = job["prior"].select(F.lit("Prior").alias("kind"), F.concat(F.col(scope).cast("string"), F.lit("-"), "lake_id").alias("id"), _listed("obs_ids").alias("links"), none("string").alias("lake_name"), "partial_f", "n_pix", digits("wse", 6), digits("area_total", 9), none("double").alias("height_imp"), none("long").alias("shore"), digits("ds_l", 9), digits("ds_q", 9))
    unseen = job["unobserved"].select(F.lit("Unobserved").alias("kind"), F.col("lake_id").alias("id"))
    return obs(job["obs"], "Obs").unionByName(obs(job["unassigned"], "Unassigned")).unionByName(prior).unionByName(unseen, allowMissingColumns=True)


#: Objects inside the tiles, split by height where that pays, and numbered by their size.
_SPLIT = """op as (select px.* from px join f using (label) where b=0 and tp=0),
  o1 as (select label, min(height) as h0, max(height) as h1, avg(pixel_area) as pa from op group by 1 having count(*)>=5 and count(*)*avg(pixel_area)>=200 and max(height)>min(height)),
  o2 as (select label, bin, count(*) as c, max(h0+(bin+0.5)*st) as x from (select label, least(floor((height-h0)/((h1-h0)/256)),255) as bin, h0, (h1-h0)/256 as st from op join o1 using (label)) group by 1,2),
  o3 as (select *, sum(c) over u as w1, sum(c*x) over u as s1, sum(c) over a as w, sum(c*x) over a as s from o2 window u as (partition by label order by bin), a as (partition by label)),
  o4 as (select label, arg_max(x, struct_pack(v:=round(w1*(w-w1)*pow(s1/w1-(s-s1)/(w-w1),2),6), b:=-bin)) as th from o3 where w>w1 group by 1),
  o5 as (select label, height>th as side, count(*) as n, avg(height) as m, stddev_pop(height) as sd, max(th) as th, max(pa) as pa from op join o4 using (label) join o1 using (label) group by 1,2),
  o6 as (select label, max(th) as th from o5 group by 1 having count(*)=2 and min(case when n*pa>=100 and n>5 and abs(th-m)>2*sd then 1 else 0 end)=1),
  sp as (select op.* exclude (label), op.label*2+case when o6.label is not null and height>th then 1 else 0 end as label, range_index as gx, azimuth_index as gy, o6.label is not null as divided from op left join o6 on o6.label=op.label)"""


@query(_JOB + ", " + _SPLIT + f""", sz as (select label from sp group by 1 having sum(case when classification in (4,5) then pixel_area end)/1e6>=0.0001 and min(range_index)<max(range_index) and min(azimuth_index)<max(azimuth_index)),
  nu as (select label, tile_number, row_number() over (partition by tile_number order by count(*) desc, label) as k from sp join sz using (label) group by 1,2),
  own as (select sp.*, concat('010', lpad(cast(tile_number as varchar),3,'0'), swath_side, lpad(cast(k as varchar),6,'0')) as oid, tile_number as sc, cast(max(case when range_index in (0,95) then 1 else 0 end) over (partition by label) as int) as partial_f from sp join nu using (label, tile_number)), """ + _CHAIN + _JOB_ROWS)
def d6_tile_job(spark, sf_dir):
    """Observed, unassigned, prior and unobserved lakes of the whole tile job: moved heights, boundaries, ids, names and storage."""
    return _job_rows(_tile_job(spark, sf_dir), "tile_number")


@query(_JOB + f""", z as (select px.*, range_index+3*(tile_number-1) as rr, (select max(azimuth_index) from px q join f g using (label) where (g.b=1 or g.tp=1) and q.tile_number=px.tile_number) as top from px join f using (label) where b=1 or tp=1),
  k as (select distinct u.label as i, v.label as j from z u join z v on v.tile_number=u.tile_number+1 and u.azimuth_index=u.top and v.azimuth_index=0 and u.rr=v.rr), kk as (select i, j from k union select j, i from k),
  m(i, j) as (select distinct label, label from z union select m.i, kk.j from m join kk on m.j=kk.i), mg as (select i as old, min(j) as merged from m group by 1),
  zm as (select z.* exclude (label), merged as label, rr as gx, azimuth_index+96*(tile_number-1) as gy, false as divided from z join mg on old=label),
  sz as (select label from zm group by 1 having sum(case when classification in (4,5) then pixel_area end)/1e6>=0.0001 and min(gx)<max(gx) and min(gy)<max(gy)),
  mt as (select label, arg_max(tile_number, struct_pack(n:=n, t:=-tile_number)) as home, sum(n) as n from (select label, tile_number, count(*) as n from zm join sz using (label) group by 1,2) group by 1),
  nu as (select label, home, row_number() over (partition by home order by n desc, label) as k from mt),
  sd as (select label, min(swath_side) as side from zm group by 1),
  own as (select zm.*, concat('010', lpad(cast(home as varchar),3,'0'), side, lpad(cast(k as varchar),6,'0')) as oid, 1 as sc, cast(0 as int) as partial_f from zm join nu using (label) join sd using (label)), """ + _CHAIN + _JOB_ROWS)
def d7_pass_job(spark, sf_dir):
    """The whole pass job: merged lakes with moved heights, boundaries, ids, names and storage, and their prior lakes."""
    p = _sensed(spark, sf_dir)
    edge = _tile_job(spark, sf_dir)["edge"].withColumn("pass_number", F.lit(1))
    t = F.col("tile_number")
    meta = p.select("tile_number").distinct().select(F.lit(1).alias("pass_number"), t, (800000 + t * 2.3).alias("near_range"), F.lit(0.75).alias("nominal_slant_range_spacing"), F.lit(96).alias("interferogram_size_azimuth"))
    return _job_rows(J.pass_job(edge, meta, ["pass_number"], _references(spark, sf_dir), min_size_km2=0.0001), "pass_number")


_EDGE_SQL = _TILE + """, ep as (select px.* from px join f using (label) where b=1 or tp=1)"""


def _edge_product(spark, sf_dir):
    p = P.located(X.pixc(spark, sf_dir)).where("classification in (3,4,5,6,7)")
    return L.edge_pixels(L.lake_labels(p)).select(*KEY, "label", "edge_loc", "longitude", "latitude", "illumination_time", "classification")


@query(_EDGE_SQL + """ select cast(count(*) as bigint) as n_rows, round(min(illumination_time),6) as start, round(max(illumination_time),6) as stop, round(min(longitude),6) as lon_min, round(max(longitude),6) as lon_max, round(min(latitude),6) as lat_min, round(max(latitude),6) as lat_max,
  (select count(*) from ep where classification=4) as read_back from ep""")
def s15_s19_edge_sink(spark, sf_dir):
    """The edge product written, with the coverage and extents that the writing pass itself observed, and read back."""
    path = scratch.new_path(spark, "edge")
    R.write_observed(_edge_product(spark, sf_dir), path, {"time": "illumination_time", "lon": "longitude", "lat": "latitude"}, by=["tile_number"])
    scratch.at_exit(spark, path)
    n = R.read(spark, path).where("classification = 4").agg(F.count(F.lit(1)).alias("read_back"))
    side = R.read_sidecar(spark, path)
    names = {"n_rows": "n_rows", "time_min": "start", "time_max": "stop", "lon_min": "lon_min", "lon_max": "lon_max", "lat_min": "lat_min", "lat_max": "lat_max"}
    one = side.select(*(F.round(c, 6).alias(a) if c != "n_rows" else F.col(c) for c, a in names.items()))
    return one.join(n, F.lit(True))


@query(f"""with {{pixc}}, k as (select {KEYS}, classification from pixc), r as (select *, reach_id as rr from pixc where river=1) select k.*, rr as reach_id from k left join (select {KEYS}, rr from r) using ({KEYS})""")
def s13_j3_bucketed_complement(spark, sf_dir):
    """The complement's join of two products that were written in buckets of their pixels' keys, which need no exchange."""
    p = X.pixc(spark, sf_dir)
    pixels = R.write_bucketed(p.select(*KEY, "classification"), scratch.new_path(spark, "pixels"), list(KEY), 8)
    river = R.write_bucketed(p.where("river = 1").select(*KEY, "reach_id"), scratch.new_path(spark, "river"), list(KEY), 8)
    return pixels.join(river.hint("merge"), list(KEY), "left")


@query("with " + _BOXES + " select lake_id from ob where x0<=500 and x0+w>=100 and y0<=400 and y0+h>=100 and (greatest(x0,100)-100)/400+(greatest(y0,100)-100)/300<=1")
def s4_spatial_scan(spark, sf_dir):
    """Prior lakes that meet a triangle, from a table clustered by place."""
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    own = X.table(spark, sf_dir, "orders").selectExpr("cast(o_orderkey as string) as lake_id", "cast(o_orderkey*7919%1000 as double) as x0", "cast(o_orderkey*104729%1000 as double) as y0", "cast(o_custkey%7+1.5 as double) as w", "cast(o_custkey%11+0.5 as double) as h")
    own = own.withColumns({"x1": F.col("x0") + F.col("w"), "y1": F.col("y0") + F.col("h")})
    lakes = own.select("lake_id", F.array(F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"), corner("x0", "y0"))).alias("rings"))
    path = scratch.new_path(spark, "lakes")
    Z.write_clustered(lakes, path, "lake_id", (0.0, 1010.0, 0.0, 1015.0))
    scratch.at_exit(spark, path)
    return Z.scan_area(spark, path, _AREA_RING, ["lake_id"])


@query("with {pixc}, p as (select tile_number, lake, range_index as r, azimuth_index as a, longitude as lon, latitude as lat from pixc where classification in (3,4,5,6)), " + """
  b as (select distinct p.tile_number, p.lake from p join p q on q.tile_number=p.tile_number and q.lake=p.lake and q.r=p.r+1 and q.a=p.a join p s on s.tile_number=p.tile_number and s.lake=p.lake and s.r=p.r and s.a=p.a+1 join p t on t.tile_number=p.tile_number and t.lake=p.lake and t.r=p.r+1 and t.a=p.a+1),
  g as (select p.*, 8*a+r as id from p join b using (tile_number, lake)),
  e as (select tile_number, lake, lon, lat from g where (select count(*) from g z where z.tile_number=g.tile_number and z.lake=g.lake and abs(z.r-g.r)+abs(z.a-g.a)=1)<4)
  select tile_number, lake, count(*) as shore, round(min(lon),6) as west, round(max(lon),6) as east, round(min(lat),6) as south, round(max(lat),6) as north from e group by 1,2""")
def g1_placed_boundary(spark, sf_dir):
    """Shore pixels and extents of every lake's boundary in longitude and latitude; lakes without a block of two by two have none.

    Shores of one or two pixels around a part of a lake make no ring of their own, so the shore is counted before short rings go.
    """
    p = X.pixc(spark, sf_dir).where("classification in (3,4,5,6)")
    at = G.placed_rings(p, LAKE, least=1)
    own = at.select(*LAKE, "x", "y").distinct()
    return own.groupBy(*LAKE).agg(F.count(F.lit(1)).alias("shore"), *(F.round(f(c), 6).alias(n) for n, f, c in (("west", F.min, "x"), ("east", F.max, "x"), ("south", F.min, "y"), ("north", F.max, "y"))))


@query()
def c4_height_kmeans(spark, sf_dir):
    return L.height_kmeans(X.pixc(spark, sf_dir).select(*KEY, "lake", "height"), LAKE).select(*KEY, "cluster")


@query("with {pixc}, q as (select tile_number, lake, range_index as r, azimuth_index as a, height from pixc), e as (select * from q where (select count(*) from q z where z.tile_number=q.tile_number and z.lake=q.lake and abs(z.a-q.a)+abs(z.r-q.r)=1)<4)"
       " select tile_number, lake, round(avg(case when not isnan(height) then height end),8) as z from e group by 1,2")
def a25_j20_ring_elevation(spark, sf_dir):
    return r6(G.ring_elevation(X.pixc(spark, sf_dir).select(*KEY, "lake", F.col("height").alias("z")), LAKE), digits=8)


@query("with {pixc}, {poly}, t as (select distinct tile_number from pixc), c as (select lake_id, tile_number, count(*) as k from pixc, poly where range_index>=x0 and range_index<x1 and azimuth_index>=y0 and azimuth_index<y1 group by 1,2)"
       " select tile_number, lake_id as area_id, round(coalesce(k,0)/((x1-x0)*(y1-y0)),8) as ratio from poly cross join t left join c using (lake_id, tile_number)")
def a32_coverage(spark, sf_dir):
    cell = (F.col("tile_number") * 10000 + F.col("azimuth_index") * 100 + F.col("range_index")).alias("id")
    cells = X.pixc(spark, sf_dir).select(cell, "tile_number", F.col("range_index").cast("double").alias("x"), F.col("azimuth_index").cast("double").alias("y"))
    return G.coverage(X.box_rings(X.poly(spark, sf_dir)).withColumnRenamed("lake_id", "area_id"), cells, 1.0, 10.0, "tile_number", digits=8)


@query("with {pixc}, {poly} select lake_id, tile_number*10000+range_index*100+azimuth_index as cell from pixc, poly where classification in (3,4) and range_index>=x0 and range_index<x1 and azimuth_index>=y0 and azimuth_index<y1")
def g7_r7_clip_cells(spark, sf_dir):
    c = X.pixc(spark, sf_dir).where("classification in (3,4)").select((F.col("tile_number") * 10000 + F.col("range_index") * 100 + F.col("azimuth_index")).alias("cell"), F.col("range_index").cast("double").alias("x"), F.col("azimuth_index").cast("double").alias("y"))
    return G.clip_cells(c, X.box_rings(X.poly(spark, sf_dir)), "cell", 10.0).select("lake_id", "cell")


@query("with recursive {poly}, rk as materialized (select lake_id as id, row_number() over (order by (x1-x0)*(y1-y0), lake_id) as k, (x1-x0)*(y1-y0) as area from poly), mt as materialized (select a.lake_id as id, list(rk.k) as bs from poly a join poly b on a.lake_id<>b.lake_id and a.x0<=b.x1 and b.x0<=a.x1 and a.y0<=b.y1 and b.y0<=a.y1 join rk on rk.id=b.lake_id group by 1), " + _GREEDY + " select id, area from rk join ch using (id)")
def t5_disjoint_smallest(spark, sf_dir):
    """Equal boxes meet one another and the same others, so of each only the smallest key can be taken."""
    p = X.poly(spark, sf_dir).groupBy("x0", "x1", "y0", "y1").agg(F.min("lake_id").alias("lake_id"))
    p = scratch.save(p, "different-boxes")
    boxes = p.select(F.col("lake_id").alias("a"), "x0", "x1", "y0", "y1")
    meets = G.touching_boxes(boxes, boxes.withColumnRenamed("a", "b"), "a", "b", 10.0)
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    return G.disjoint_smallest(p.select(F.col("lake_id").alias("id"), area.alias("area")), meets)


@query("with {pixc}, q as (select tile_number as t, range_index as r, azimuth_index as a from pixc where classification in (3,4,5)), n as (select t, r+1 as r, a from q union all select t, r-1, a from q union all select t, r, a+1 from q union all select t, r, a-1 from q),"
       " i as (select t, count(*) as inner_sides from n join q using (t, r, a) group by 1), s as (select t, count(*) as k from q group by 1)"
       " select t as tile_number, cast(4*k-coalesce(inner_sides,0) as bigint) as vertices, cast(k as double) as area, cast(4*k-coalesce(inner_sides,0) as bigint) as steps from s left join i using (t)")
def g13_g1_ordered_rings(spark, sf_dir):
    c = X.pixc(spark, sf_dir).where("classification in (3,4,5)").select("tile_number", "range_index", "azimuth_index")
    return _ring_sums(G.ordered_rings(c, ["tile_number"]), "tile_number")


def _ring_sums(v, key):
    from pyspark.sql import Window

    w = Window.partitionBy(key, "ring").orderBy("position")
    nx = lambda k: F.coalesce(F.lead(k).over(w), F.first(k).over(w))
    v = v.withColumns({"x2": nx("x"), "y2": nx("y")})
    return v.groupBy(key).agg(F.count(F.lit(1)).alias("vertices"), (F.sum(F.col("x") * F.col("y2") - F.col("x2") * F.col("y")) / 2).alias("area"), F.sum((F.abs(F.col("x") - F.col("x2")) + F.abs(F.col("y") - F.col("y2")) == 1).cast("long")).alias("steps"))


@query("""with {pixc}, big as (select tile_number, lake from pixc group by 1,2 having count(*)>=3),
  e as (select tile_number, lake, azimuth_index as y, unnest([min(range_index), max(range_index)]) as x from pixc join big using (tile_number, lake) group by 1,2,3), d as (select distinct tile_number, lake, x, y from e),
  s as (select p.tile_number, p.lake, p.x, p.y, q.x as qx, q.y as qy, min(case when (q.x-p.x)*(r.y-p.y)-(q.y-p.y)*(r.x-p.x)>0 or ((q.x-p.x)*(r.y-p.y)=(q.y-p.y)*(r.x-p.x) and (q.x-p.x)*(r.x-p.x)+(q.y-p.y)*(r.y-p.y)>0) then 1 else 0 end) as ok
    from d p join d q on q.tile_number=p.tile_number and q.lake=p.lake and (q.x<>p.x or q.y<>p.y) join d r on r.tile_number=p.tile_number and r.lake=p.lake and (r.x<>p.x or r.y<>p.y) group by 1,2,3,4,5,6)
  select distinct tile_number, lake, cast(x as double) as x, cast(y as double) as y from s where ok=1""")
def g3_convex_hull(spark, sf_dir):
    """The hulls' vertices; a point is one if all others lie on the left of a line from it to another, or ahead on it."""
    p = X.pixc(spark, sf_dir).select(*LAKE, "azimuth_index", F.col("range_index").cast("double").alias("x"), F.col("azimuth_index").cast("double").alias("y"))
    big = p.groupBy(*LAKE).agg(F.count(F.lit(1)).alias("k")).where("k >= 3").select(*LAKE)
    hulls = G.convex_hulls(p.join(big, LAKE, "left_semi"), LAKE)
    return hulls.select(*LAKE, F.explode(F.slice("ring", 1, F.size("ring") - 1)).alias("v")).select(*LAKE, "v.x", "v.y")


_CORNERS = "[struct_pack(x:=b,y:=b), struct_pack(x:=b,y:=b+10), struct_pack(x:=a,y:=a+10), struct_pack(x:=a,y:=a), struct_pack(x:=b,y:=b)]", "[struct_pack(x:=a,y:=a), struct_pack(x:=a,y:=a+10), struct_pack(x:=b,y:=b+10), struct_pack(x:=b,y:=b), struct_pack(x:=a,y:=a)]"


@query(f"""with c as (select s_suppkey, s_suppkey*1e0 as a, s_suppkey+1e0 as b from supplier), r as (select *, case when s_suppkey%2=0 then {_CORNERS[0]} else {_CORNERS[1]} end as ring from c)
  select s_suppkey, cast(k-1 as int) as position, ring[k].x as x, ring[k].y as y, case when s_suppkey%2=0 then a else b end as line_x2 from r, range(1,6) t(k)""")
def x16_tile_ring(spark, sf_dir):
    from mereflow.functions import scalars as S

    k = F.col("s_suppkey") * 1.0
    cols = {f"{w}_{e}_{c}": (k if w == "inner" else k + 1) + (0 if e == "first" else 10) * (1 if c == "latitude" else 0) for w in ("inner", "outer") for e in ("first", "last") for c in ("longitude", "latitude")}
    t = X.table(spark, sf_dir, "supplier").select("s_suppkey").withColumns(cols)
    side = F.when(F.col("s_suppkey") % 2 == 0, "L").otherwise("R")
    out = t.select("s_suppkey", F.posexplode(S.tile_ring(side)).alias("position", "p"), S.row_line("first", side)[1]["x"].alias("line_x2"))
    return out.select("s_suppkey", "position", "p.x", "p.y", "line_x2")
