"""Pixel clouds, lakes and tracks derived from the driver's tables, in SQL that Spark and DuckDB share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of the derived pixel cloud; one row per (tile, range, azimuth) cell of ``lineitem``.
PIXC = {
    "cycle_number": "cast(1 as int)",
    "pass_number": "cast(tile_number%7+1 as int)",
    "swath_side": "case when tile_number%2=0 then 'L' else 'R' end",
    "classification": "cast(max(l_linenumber)%6+2 as int)",
    "longitude": "cast(tile_number*0.01+range_index*0.0001 as double)",
    "latitude": "cast(45+tile_number*0.01+azimuth_index*0.0001 as double)",
    "height": "case when max(l_partkey)%53=0 then cast('NaN' as double) else max(l_quantity)+min(l_discount) end",
    "illumination_time": "cast(600000000+tile_number*10+azimuth_index*0.01 as double)",
    "pixel_area": "50+max(l_quantity)",
    "height_std": "0.05+min(l_tax)",
    "water_frac": "0.1+max(l_discount)",
    "water_frac_uncert": "0.01+min(l_tax)/10",
    "false_detection_rate": "0.02+min(l_discount)/10",
    "missed_detection_rate": "0.03+max(l_tax)/10",
    "darea_dheight": "0.02+min(l_discount)/100",
    "bright_land_flag": "cast(max(l_partkey)%2 as int)",
    "layover_impact": "max(l_tax)-min(l_discount)",
    "eff_num_rare_looks": "4+max(l_discount)",
    "eff_num_medium_looks": "36+max(l_tax)",
    "cross_track": "10000+max(l_extendedprice)%60000",
    "sig0": "10+max(l_discount)",
    "ifg_re": "0.5+max(l_discount)",
    "ifg_im": "0.2+min(l_tax)",
    "power_plus_y": "1+max(l_tax)",
    "power_minus_y": "1.1+min(l_discount)",
    "phase_noise_std": "case when max(l_suppkey)%31=0 then -1.0 else 0.01+min(l_tax) end",
    "dheight_dphase": "case when max(l_partkey)%2=0 then -1 else 1 end*(5+max(l_discount))",
    "dlatitude_dphase": "0.00001*(1+min(l_discount))",
    "dlongitude_dphase": "0.00002*(1+max(l_tax))",
    "model_dry_tropo_cor": "-2.3-min(l_tax)",
    "model_wet_tropo_cor": "-0.1-max(l_tax)",
    "iono_cor_gim_ka": "-0.01*max(l_discount)",
    "height_cor_xover": "0.01*min(l_discount)",
    "geoid": "10+min(l_tax)",
    "solid_earth_tide": "0.1*max(l_tax)",
    "load_tide_fes": "0.01*max(l_discount)",
    "load_tide_got": "0.02*max(l_discount)",
    "pole_tide": "case when max(l_partkey)%97=0 then cast('Infinity' as double) else 0.001*min(l_linenumber) end",
    "incidence": "0.02+min(l_discount)/10",
    "interferogram_qual": "cast(min(l_suppkey)%8 as bigint)",
    "classification_qual": "cast(max(l_partkey)%4 as bigint)",
    "geolocation_qual": "cast(max(l_suppkey)%2*64+case when max(l_partkey)%9=0 then 8388608 else 0 end as bigint)",
    "reach_id": "concat('7', lpad(cast(max(l_suppkey)%5 as varchar(10)),9,'0'), cast(max(l_suppkey)%4 as varchar(10)))",
    "node_id": "cast(max(l_partkey)%12 as bigint)",
    "river": "cast(case when max(l_partkey)%11=0 then 1 else 0 end as int)",
}
_CELL = "cast((l_partkey*7+l_linenumber*13)%96 as int) as range_index, cast((l_suppkey*11+l_orderkey)%96 as int) as azimuth_index"

#: CTE ``pixc`` for the oracle.
PIXC_SQL = f"""pixc as (
  select tile_number, range_index, azimuth_index, range_index//24*4+azimuth_index//24 as lake, {", ".join(f"{e} as {c}" for c, e in PIXC.items())}
  from (select l.*, l_orderkey%(select cast(greatest(1, floor(count(*)/3750)) as bigint) from lineitem)+1 as tile_number, {_CELL} from lineitem l) x
  group by tile_number, range_index, azimuth_index)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pixc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived pixel cloud; ``lake`` numbers 24 x 24 blocks of a tile."""
    line = table(spark, sf_dir, "lineitem")
    tiles = max(1, line.count() // 3750)
    cells = line.withColumn("tile_number", F.col("l_orderkey") % tiles + 1).withColumns(
        {
            "range_index": F.expr("cast((l_partkey*7+l_linenumber*13)%96 as int)"),
            "azimuth_index": F.expr("cast((l_suppkey*11+l_orderkey)%96 as int)"),
        }
    )
    grouped = cells.groupBy("tile_number", "range_index", "azimuth_index").agg(*(F.expr(e).alias(c) for c, e in PIXC.items()))
    return grouped.withColumn("lake", F.expr("range_index div 24 * 4 + azimuth_index div 24"))


#: Pass-level lake rows, prior lakes and boxes, as CTEs; the same text runs in Spark.
LAKESP_SQL = """lakesp as (
  select concat('1', lpad(cast(o_custkey%211 as varchar(10)),9,'0')) as lake_id,
    cast(o_custkey%3+1 as int) as cycle_number, cast(o_orderkey%40+1 as int) as pass_number,
    round(avg(o_totalprice)/1000,3) as wse, round(min(o_totalprice)/10000,6) as area_total,
    round(0.01+max(o_totalprice)/1000000,6) as wse_u, round(0.02+max(o_totalprice)/2000000,6) as area_tot_u,
    10+min(o_totalprice)/50000 as geoid_hght, cast(600000000+max(o_orderkey)*10 as double) as time,
    cast(case when max(o_orderkey)%5=0 then 1 else 0 end as int) as partial_f,
    cast(max(o_orderkey)%3 as int) as quality_f, round(min(o_totalprice)/1000000,6) as dark_frac,
    case when max(o_orderkey)%7=0 then 'no_data' else concat('2', cast(max(o_orderkey) as varchar(20))) end as obs_id,
    cast(count(*) as bigint) as n
  from orders group by o_custkey%211, o_custkey%3, o_orderkey%40)"""
PLD_SQL = """pld as (
  select concat('1', lpad(cast(c_custkey%211 as varchar(10)),9,'0')) as lake_id,
    round(max(c_acctbal)/100,3) as ref_wse, round(1+abs(min(c_acctbal))/1000,6) as ref_area,
    round(abs(max(c_acctbal))/100000,6) as ref_wse_u, cast(null as double) as ref_area_u,
    cast(case when max(c_custkey)%3=0 then -99999999 else max(c_custkey)%7/10.0 end as double) as ds_t0,
    cast(max(c_custkey)%9-1 as int) as res_id, min(c_name) as names
  from customer group by c_custkey%211)"""
POLY_SQL = """poly as (
  select concat('1', lpad(cast(s_suppkey as varchar(10)),9,'0')) as lake_id,
    cast(s_suppkey*17%80 as double) as x0, cast(s_suppkey*29%80 as double) as y0,
    cast(s_suppkey*17%80+4+s_suppkey%11 as double) as x1, cast(s_suppkey*29%80+4+s_suppkey%7 as double) as y1
  from supplier)"""


def _derived(name: str, sql: str, source: str):
    body = sql.split("as (", 1)[1].rstrip()[:-1]

    def load(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(body.replace(f"from {source}", "from {src}"), src=table(spark, sf_dir, source))

    load.__name__ = name
    load.__doc__ = f"The derived table ``{name}``, from ``{source}``."
    return load


lakesp = _derived("lakesp", LAKESP_SQL, "orders")
#: The same rows, but no pass sees every third lake whole.
LAKESP_PART_SQL = LAKESP_SQL.replace("max(o_orderkey)%5=0", "max(o_orderkey)%5=0 or o_custkey%211%3=0")
lakesp_part = _derived("lakesp", LAKESP_PART_SQL, "orders")
pld = _derived("pld", PLD_SQL, "customer")
poly = _derived("poly", POLY_SQL, "supplier")


def box_rings(df: DataFrame) -> DataFrame:
    """``poly`` with its box as closed rings, first the outer one."""
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    ring = F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"), corner("x0", "y0"))
    return df.select("lake_id", F.array(ring).alias("rings"))
