"""Star tables made from the driver's tables: the same text in Spark SQL and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumenforge.sources.staging import staged

TABLES = ("lineitem", "part", "supplier")

_K = """
-- k: one row per (order, line), integer seeds only
k AS (SELECT l_orderkey*8 + l_linenumber AS source_id,
             CAST(round(max(l_extendedprice)*100) AS BIGINT) AS e,
             min(l_partkey) AS pk, CAST(max(l_quantity) AS BIGINT) AS q
      FROM lineitem GROUP BY l_orderkey*8 + l_linenumber),"""
_REST = """
gaia_raw AS (SELECT source_id, pk,
  CAST(e%36000 AS DOUBLE)/100 AS ra,
  CAST((source_id*7919+e)%17999 - 8999 AS DOUBLE)/100 AS dec,
  CAST(q*3 - 70 AS DOUBLE) AS pmra, CAST(60 - q*2 AS DOUBLE) AS pmdec,
  CASE WHEN e%10 IN (0,3) THEN NULL WHEN e%10=1 THEN CAST(0 AS DOUBLE) WHEN e%10=2 THEN CAST(-1 AS DOUBLE)
       ELSE CAST(1+e%5000 AS DOUBLE)/100 END AS parallax,
  CASE WHEN q%7=0 THEN NULL WHEN q%7=1 THEN CAST(0 AS DOUBLE) ELSE CAST(1+e%97 AS DOUBLE)/100 END AS parallax_error,
  CASE WHEN q%5=0 THEN NULL ELSE CAST(10+e%4000 AS DOUBLE) END AS r_med_geo,
  CASE WHEN q%3=0 THEN NULL ELSE 9+CAST(e%4000 AS DOUBLE)*3/4 END AS r_lo_geo,
  12+CAST(e%4000 AS DOUBLE)*5/4 AS r_hi_geo,
  CASE WHEN q%5 IN (0,1) THEN NULL ELSE CAST(11+e%3900 AS DOUBLE) END AS r_med_photogeo,
  CASE WHEN q%3 IN (0,1) THEN NULL ELSE 10+CAST(e%3900 AS DOUBLE)*7/8 END AS r_lo_photogeo,
  12+CAST(e%3900 AS DOUBLE)*9/8 AS r_hi_photogeo,
  CASE WHEN e%23=0 THEN NULL ELSE CAST(e%2000 AS DOUBLE)/100 END AS phot_g_mean_mag,
  CASE WHEN e%19=0 THEN NULL ELSE CAST((e+source_id)%2100 AS DOUBLE)/100 END AS phot_bp_mean_mag,
  CASE WHEN e%17=0 THEN NULL ELSE CAST((e+source_id)%1900 AS DOUBLE)/100 END AS phot_rp_mean_mag,
  CASE WHEN e%4=0 THEN NULL ELSE CAST(e%2700 AS DOUBLE)/100-11 END AS mg_gspphot,
  CASE WHEN q%4=0 THEN NULL ELSE CAST(e%2700 AS DOUBLE)/100-11.25 END AS mg_gspphot_lower,
  CASE WHEN q%6=0 THEN NULL ELSE CAST(e%2700 AS DOUBLE)/100-10.5 END AS mg_gspphot_upper,
  CASE WHEN e%6=0 THEN NULL ELSE CAST(e%60 AS DOUBLE)/10-0.5 END AS ag_gspphot,
  CASE WHEN q%9=0 THEN CAST(1500+e%60000 AS DOUBLE) END AS teff_esphs,
  CASE WHEN q%8=0 THEN CAST(1800+e%9000 AS DOUBLE) END AS teff_gspspec,
  CASE WHEN q%11=0 THEN CAST(1900+e%900 AS DOUBLE) END AS teff_espucd,
  CASE WHEN q%2=0 THEN CAST(1700+e%8000 AS DOUBLE) END AS teff_gspphot,
  CASE WHEN e%13=0 THEN NULL ELSE CAST(50+e%300 AS DOUBLE)/100 END AS ruwe
  FROM k),
hip_raw AS (SELECT p_partkey+1 AS hip, CASE WHEN p_size%6=0 THEN 95 WHEN p_size%7=0 THEN NULL ELSE 5 END AS sn,
  CAST((p_partkey*617)%36000 AS DOUBLE)/100 AS rarad, CAST((p_partkey*331)%17999 - 8999 AS DOUBLE)/100 AS derad,
  CASE WHEN p_size%10=0 THEN CAST(0 AS DOUBLE) WHEN p_size%13=0 THEN CAST(-2 AS DOUBLE) ELSE CAST(5+p_partkey%2000 AS DOUBLE)/10 END AS plx,
  CASE WHEN p_size%17=0 THEN NULL ELSE CAST(1+p_size AS DOUBLE)/100 END AS e_plx,
  CAST(p_size-25 AS DOUBLE) AS pmra, CAST(12-p_size AS DOUBLE) AS pmde,
  CAST(p_partkey%1300 AS DOUBLE)/100 AS hpmag, CASE WHEN p_size%9=0 THEN NULL ELSE CAST(p_size*8-60 AS DOUBLE)/100 END AS bv
  FROM part),
xmatch AS (SELECT min(source_id) AS gaia_source_id, pk+1 AS hip_source_id,
  CAST(1 + CASE WHEN pk%12=0 THEN 1 ELSE 0 END AS INT) AS number_of_neighbours,
  CAST(pk%100 AS DOUBLE)/1000 AS angular_distance FROM gaia_raw WHERE pk%5<>0 GROUP BY pk)
,
ov AS (SELECT concat('ov.', CAST(s_suppkey AS STRING)) AS override_id,
  CASE s_suppkey%5 WHEN 0 THEN 'add' WHEN 2 THEN 'drop' WHEN 4 THEN 'drop' ELSE 'replace' END AS action,
  CASE s_suppkey%5 WHEN 0 THEN 'manual' WHEN 1 THEN 'hip' WHEN 2 THEN 'hip' ELSE 'gaia' END AS source,
  CASE s_suppkey%5 WHEN 0 THEN concat('m', CAST(s_suppkey AS STRING))
    WHEN 3 THEN CAST(x.gaia_source_id AS STRING) WHEN 4 THEN CAST(900000000+s_suppkey AS STRING)
    ELSE CAST(s_suppkey*3+1 AS STRING) END AS source_id,
  CASE WHEN s_suppkey%5 IN (0,1,3) THEN CAST((s_suppkey*977)%36000 AS DOUBLE)/100 END AS ra_deg,
  CASE WHEN s_suppkey%5 IN (0,1,3) THEN CAST((s_suppkey*613)%17999 - 8999 AS DOUBLE)/100 END AS dec_deg,
  CASE WHEN s_suppkey%5 IN (0,1,3) THEN CAST(1+s_suppkey%500 AS DOUBLE) END AS r_pc,
  CASE WHEN s_suppkey%5 IN (0,1,3) THEN CAST(s_suppkey%20 AS DOUBLE)-5 END AS mag_abs,
  CASE WHEN s_suppkey%5 IN (0,1,3) THEN CAST(3000+s_suppkey%9000 AS DOUBLE) END AS teff
  FROM supplier LEFT JOIN xmatch x ON x.hip_source_id = s_suppkey*3+3),
hip_hd AS (SELECT p_partkey+1 AS hip, 1000+p_partkey AS hd FROM part WHERE p_partkey%3<>0),
iv27a AS (SELECT p_partkey+1 AS hip, 5000+p_partkey AS hd,
  CASE p_size%8 WHEN 0 THEN 'alf' WHEN 1 THEN 'kap01' WHEN 2 THEN 'mu.' WHEN 3 THEN 'pi.06'
    WHEN 4 THEN 'A.' WHEN 5 THEN '' WHEN 6 THEN 'ksi' ELSE 'zz9' END AS bayer, p_size AS fl,
  CASE p_partkey%3 WHEN 0 THEN 'Cas' WHEN 1 THEN 'Cyg' ELSE '' END AS cst FROM part WHERE p_partkey%2=0),
names AS (SELECT 1000+p_partkey AS hd, CASE WHEN p_size%3=0 THEN concat(p_name, '; other (with HD1)')
    WHEN p_size%3=1 THEN concat(p_name, ' (see HD2)') ELSE '' END AS name FROM part WHERE p_partkey%4=1)"""
ADAPTER = f"""
WITH{_K}{_REST}"""


#: More tables for the adapter: rows that repeat a key with other values, and `seq`, the order in which they are met.
REPEATED = """,
xm_rows AS (SELECT gaia_source_id, hip_source_id, number_of_neighbours, angular_distance, hip_source_id*8 AS seq FROM xmatch
  UNION ALL SELECT gaia_source_id, hip_source_id, number_of_neighbours + 1, angular_distance + 1, hip_source_id*8 - 19 FROM xmatch WHERE hip_source_id%7=0
  UNION ALL SELECT gaia_source_id, hip_source_id, number_of_neighbours + 2, angular_distance + 2, hip_source_id*8 + 13 FROM xmatch WHERE hip_source_id%11=0),
hip_rows AS (SELECT hip, sn, rarad, derad, plx, e_plx, pmra, pmde, hpmag, bv, hip*8 AS seq FROM hip_raw
  UNION ALL SELECT hip, sn, rarad, derad, plx*2, e_plx, pmra, pmde, hpmag + 1, bv, hip*8 + 13 FROM hip_raw WHERE hip%9=2
  UNION ALL SELECT hip, sn, rarad, derad, plx*3, e_plx, pmra, pmde, hpmag + 2, bv, hip*8 - 19 FROM hip_raw WHERE hip%5=2),
hd_rows AS (SELECT hip, hd, hip*8 AS seq FROM hip_hd UNION ALL SELECT hip, hd + 100000, hip*8 - 19 FROM hip_hd WHERE hip%6=1),
star_rows AS (SELECT hip, hd, bayer, fl, cst, hip*8 AS seq FROM iv27a UNION ALL SELECT hip, hd, 'bet', fl + 1, cst, hip*8 + 13 FROM iv27a WHERE hip%10=1
  UNION ALL SELECT hip, hd, 'gam', fl + 2, cst, hip*8 - 19 FROM iv27a WHERE hip%14=1),
name_rows AS (SELECT hd, name, hd*8 AS seq FROM names UNION ALL SELECT hd, concat('Zz ', name), hd*8 - 19 FROM names WHERE hd%9=2),
link_rows AS (SELECT gaia_source_id, hip_source_id, hip_source_id*8 AS seq FROM xmatch UNION ALL SELECT gaia_source_id - 1, hip_source_id, hip_source_id*8 + 13 FROM xmatch WHERE hip_source_id%5=3),
own_rows AS (SELECT 'hip' AS source, CAST(p_partkey + 1 AS STRING) AS source_id, concat('Star ', p_name) AS proper_name, p_partkey*2 AS seq FROM part WHERE p_partkey%50=4
  UNION ALL SELECT 'hip', CAST(p_partkey + 1 AS STRING), concat('A ', p_name), p_partkey*2 + 1 FROM part WHERE p_partkey%100=4
  UNION ALL SELECT 'manual', concat('m', CAST(p_partkey AS STRING)), 'Named', p_partkey*2 FROM part WHERE p_partkey%70=6)"""


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapter's k, grouped and written once for all queries that are given it."""
    return staged(frame(spark, sf_dir, "SELECT * FROM k"), "seeds")


def frame(spark: SparkSession, sf_dir: str, query: str, k: DataFrame | None = None) -> DataFrame:
    """A query over the adapter's tables: gaia_raw, hip_raw, xmatch, ov, hip_hd, iv27a, names. k: seeds(), so that they are not
    grouped again."""
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)
    if k is None:
        return spark.sql(f"{ADAPTER}\n{query}")
    k.createOrReplaceTempView("k")
    return spark.sql(f"WITH{_REST}\n{query}")
