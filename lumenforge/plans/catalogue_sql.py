"""The catalogue queries as DuckDB SQL."""

from __future__ import annotations

from lumenforge.functions.ids import GREEK
from lumenforge.operators.schemas import DECISIONS, DENSE, ISSUES
from lumenforge.plans.adapter import ADAPTER, REPEATED

_R = lambda c: f"round({c}, 6) + 0.0 AS {c}"
_DOUBLES = [c for c, t in DENSE.items() if t == "double"]


def _propagated(name: str, table: str, ra: str, dec: str, pmra: str, pmde: str, years: str) -> str:
    """x, y, z of rows with a distance d, then the direction again."""
    k = f"(d * {years} * pi() / 648000000.0)"
    a, b = f"radians({ra})", f"radians({dec})"
    return f"""
{name}_xyz AS (SELECT *,
  d*cos({b})*cos({a}) - {k}*{pmra}*sin({a}) - {k}*{pmde}*sin({b})*cos({a}) AS x_icrs_pc,
  d*cos({b})*sin({a}) + {k}*{pmra}*cos({a}) - {k}*{pmde}*sin({b})*sin({a}) AS y_icrs_pc,
  d*sin({b}) + {k}*{pmde}*cos({b}) AS z_icrs_pc FROM {table}),
{name}_sky AS (SELECT *, CASE WHEN atan2(y_icrs_pc, x_icrs_pc) < 0 THEN degrees(atan2(y_icrs_pc, x_icrs_pc) + 2*pi()) ELSE degrees(atan2(y_icrs_pc, x_icrs_pc)) END AS ra_deg,
  degrees(atan2(z_icrs_pc, sqrt(x_icrs_pc*x_icrs_pc + y_icrs_pc*y_icrs_pc))) AS dec_deg, sqrt(x_icrs_pc*x_icrs_pc + y_icrs_pc*y_icrs_pc + z_icrs_pc*z_icrs_pc) AS r_pc FROM {name}_xyz)"""


def _bv_teff(bv: str) -> str:
    x = f"(0.92*least(greatest({bv}, -0.5), 2.5))"
    return f"least(greatest(4600.0*(1.0/({x}+1.7) + 1.0/({x}+0.62)), 1000.0), 40000.0)"


_GAIA = (
    f"""
gaia_scored AS (SELECT *, phot_bp_mean_mag - phot_rp_mean_mag AS bp_rp,
  CASE WHEN parallax > 0 AND parallax_error > 0 THEN parallax_error/parallax END AS s1,
  CASE WHEN r_med_geo > 0 THEN (r_hi_geo - r_lo_geo)/(2*greatest(r_med_geo, 1e-12)) + 0.01 END AS s2,
  CASE WHEN r_med_photogeo > 0 THEN (r_hi_photogeo - r_lo_photogeo)/(2*greatest(r_med_photogeo, 1e-12)) + 0.02 END AS s3,
  CASE WHEN ag_gspphot >= 0 AND ag_gspphot < 5 THEN ag_gspphot END AS absorbed,
  CASE WHEN mg_gspphot > -10 AND mg_gspphot < 15 THEN mg_gspphot END AS good_mg FROM gaia_raw),
gaia_tier AS (SELECT *, CASE WHEN s1 = least(s1,s2,s3) THEN 1 WHEN s2 = least(s1,s2,s3) THEN 2 WHEN s3 = least(s1,s2,s3) THEN 3 WHEN r_med_photogeo > 0 THEN 7
  WHEN r_med_geo > 0 THEN 6 WHEN parallax > 0 THEN 5 WHEN good_mg IS NOT NULL AND phot_g_mean_mag IS NOT NULL THEN 8 WHEN phot_g_mean_mag IS NOT NULL THEN 9 ELSE 0 END AS src FROM gaia_scored),
gaia_far AS (SELECT *, CASE src WHEN 1 THEN 1000.0/parallax WHEN 2 THEN r_med_geo WHEN 3 THEN r_med_photogeo WHEN 7 THEN r_med_photogeo WHEN 6 THEN r_med_geo WHEN 5 THEN 1000.0/parallax
  WHEN 8 THEN pow(10.0, (phot_g_mean_mag - coalesce(absorbed, 0) - good_mg + 5.0)/5.0) WHEN 9 THEN pow(10.0, (phot_g_mean_mag - coalesce(absorbed, 0) - 4.0 + 5.0)/5.0) END AS d,
  CASE src WHEN 1 THEN s1 WHEN 2 THEN s2 WHEN 3 THEN s3 WHEN 7 THEN 10.0 WHEN 6 THEN 10.0 WHEN 5 THEN 10.0 WHEN 8 THEN 20.0 WHEN 9 THEN 50.0 END AS astrometry_quality FROM gaia_tier),"""
    + _propagated("g", "gaia_far", "ra", "dec", "pmra", "pmdec", "0.0")
    + f""",
gaia_teff AS (SELECT *, CASE WHEN teff_esphs BETWEEN 2000 AND 50000 THEN 1 WHEN teff_gspspec BETWEEN 2000 AND 50000 THEN 2 WHEN teff_espucd BETWEEN 2000 AND 50000 THEN 3
  WHEN teff_gspphot BETWEEN 2000 AND 50000 THEN 4 WHEN bp_rp IS NOT NULL THEN 5 ELSE 0 END AS tsrc FROM g_sky),
gaia AS (SELECT 'gaia' AS source, source_id, x_icrs_pc, y_icrs_pc, z_icrs_pc, ra_deg, dec_deg, r_pc,
  CASE WHEN good_mg IS NOT NULL THEN good_mg WHEN d > 0 THEN phot_g_mean_mag - 5*log10(d/10.0) - coalesce(absorbed, 0) END AS mag_abs,
  CASE tsrc WHEN 1 THEN teff_esphs WHEN 2 THEN teff_gspspec WHEN 3 THEN teff_espucd WHEN 4 THEN teff_gspphot WHEN 5 THEN {_bv_teff("(0.77*least(greatest(bp_rp, -0.5), 3.5) + 0.20)")} ELSE 5800.0 END AS teff,
  CAST(src + tsrc*16 + CASE WHEN d > 0 THEN 128 ELSE 0 END + CASE WHEN src IN (1,2,3) THEN 0 ELSE 256 END + CASE WHEN d > 0.1 AND d < 200000 THEN 512 ELSE 0 END + 1024 AS INTEGER) AS quality_flags,
  astrometry_quality, CASE WHEN good_mg IS NOT NULL THEN abs(mg_gspphot_upper - mg_gspphot_lower)/2 ELSE 2.17*astrometry_quality END AS photometry_quality, ruwe, phot_g_mean_mag, parallax, bp_rp FROM gaia_teff),"""
)
_HIP = (
    """
hip_far AS (SELECT *, 1000.0/plx AS d FROM hip_raw WHERE plx > 0),"""
    + _propagated("h", "hip_far", "rarad", "derad", "pmra", "pmde", "24.75")
    + f""",
hip AS (SELECT 'hip' AS source, CAST(hip AS BIGINT) AS source_id, x_icrs_pc, y_icrs_pc, z_icrs_pc, ra_deg, dec_deg, r_pc, hpmag - 5*log10(d/10.0) AS mag_abs,
  CASE WHEN bv IS NOT NULL THEN {_bv_teff("bv")} ELSE 5800.0 END AS teff,
  CAST(4 + CASE WHEN bv IS NOT NULL THEN 96 ELSE 0 END + 128 + CASE WHEN e_plx > 0 THEN 0 ELSE 256 END + CASE WHEN d > 0.1 AND d < 200000 THEN 512 ELSE 0 END + 2048 AS INTEGER) AS quality_flags,
  CASE WHEN e_plx > 0 THEN e_plx/plx END AS astrometry_quality, 2.17*CASE WHEN e_plx > 0 THEN e_plx/plx END AS photometry_quality, CAST(sn AS INTEGER) AS Sn, hpmag AS Hpmag FROM h_sky),"""
)
_OVERRIDES = """
overrides AS (SELECT source, source_id, r_pc*cos(radians(dec_deg))*cos(radians(ra_deg)) AS x_icrs_pc, r_pc*cos(radians(dec_deg))*sin(radians(ra_deg)) AS y_icrs_pc, r_pc*sin(radians(dec_deg)) AS z_icrs_pc,
  ra_deg, dec_deg, r_pc, mag_abs, teff, CASE WHEN action <> 'drop' THEN 138 END AS quality_flags, CASE WHEN action <> 'drop' THEN 0.0::DOUBLE END AS astrometry_quality,
  CASE WHEN action <> 'drop' THEN 0.0::DOUBLE END AS photometry_quality, override_id, action, concat('why ', override_id) AS override_reason, 'v1' AS override_policy_version FROM ov),"""
_GREEK = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in GREEK.items())
_IDENTIFIERS = f"""
coded AS (SELECT hip, hd, nullif(trim(cst), '') AS cst, fl, regexp_replace(rtrim(trim(bayer), '.'), '^([A-Za-z]+)\\.([0-9]+)$', '\\1\\2') AS code FROM iv27a),
spelt AS (SELECT *, regexp_extract(code, '^([A-Za-z]+)([0-9]*)$', 1) AS letters, regexp_extract(code, '^([A-Za-z]+)([0-9]*)$', 2) AS num FROM coded),
rooted AS (SELECT *, CASE lower(letters) {_GREEK} END AS greek FROM spelt),
stars AS (SELECT hip, hd, fl, cst, CASE WHEN code <> '' THEN concat_ws(' ', CASE WHEN letters = '' THEN code WHEN greek IS NULL THEN letters ELSE concat(greek, CASE WHEN num = '' THEN '' ELSE CAST(CAST(num AS BIGINT) AS VARCHAR) END) END, cst) END AS bayer FROM rooted),
proper AS (SELECT hd, nullif(trim(regexp_replace(string_split(trim(name), ';')[1], '\\s*\\(.*$', '')), '') AS proper_name FROM names),
joined AS (SELECT coalesce(s.hip, m.hip) AS hip, coalesce(m.hd, s.hd) AS hd, s.bayer, s.fl, s.cst FROM stars s FULL JOIN hip_hd m ON s.hip = m.hip),
identifiers AS (SELECT 'hip' AS source, CAST(j.hip AS VARCHAR) AS source_id, x.gaia_source_id, CAST(j.hip AS BIGINT) AS hip_id, CAST(j.hd AS BIGINT) AS hd, j.bayer, CAST(CASE WHEN j.fl > 0 THEN j.fl END AS BIGINT) AS flamsteed, j.cst AS constellation, p.proper_name
  FROM joined j LEFT JOIN proper p ON p.hd = j.hd AND p.proper_name IS NOT NULL LEFT JOIN xmatch x ON x.hip_source_id = j.hip WHERE j.bayer IS NOT NULL OR p.proper_name IS NOT NULL),
labels AS (SELECT source, source_id, coalesce(proper_name, CASE WHEN bayer IS NOT NULL THEN concat_ws(' ', bayer, constellation) END, 'HD ' || hd, 'HIP ' || hip_id) AS label FROM identifiers),"""
_PAYLOAD = [c for c in DENSE if c not in ("source", "source_id")]


def _cols(alias: str) -> str:
    return ", ".join(f"{alias}.{c}" for c in _PAYLOAD)


_BODY = ", ".join(f"CASE WHEN kind = 'replace' THEN o.{c} WHEN kind = 'pair' AND w = 'hip' THEN h.{c} ELSE g.{c} END AS {c}" for c in _PAYLOAD)
_INF = "CAST('inf' AS DOUBLE)"
_MERGE = f"""
targets AS (SELECT * FROM overrides WHERE action <> 'add'),
led AS (SELECT g.source_id AS gid, x.hip_source_id AS hid, h.source_id AS hrow, x.number_of_neighbours AS nb, x.angular_distance AS ang, coalesce(a.override_id, b.override_id) AS oid
  FROM gaia g LEFT JOIN xmatch x ON x.gaia_source_id = g.source_id LEFT JOIN hip h ON h.source_id = x.hip_source_id
  LEFT JOIN targets a ON a.source = 'gaia' AND a.source_id = CAST(g.source_id AS VARCHAR) LEFT JOIN targets b ON b.source = 'hip' AND b.source_id = CAST(x.hip_source_id AS VARCHAR)),
weighed AS (SELECT l.*, CASE WHEN o.override_id IS NOT NULL THEN o.action WHEN hrow IS NULL THEN 'alone' ELSE 'pair' END AS kind, coalesce(g.astrometry_quality, {_INF}) AS gs, coalesce(h.astrometry_quality, {_INF}) AS hs, h.Sn AS sn,
  coalesce(g.phot_g_mean_mag, CASE WHEN g.r_pc > 0 THEN g.mag_abs + 5*log10(g.r_pc/10.0) END) AS bright FROM led l JOIN gaia g ON g.source_id = l.gid LEFT JOIN hip h ON h.source_id = l.hrow LEFT JOIN targets o ON o.override_id = l.oid),
judged AS (SELECT *, CASE WHEN bright < 3.5 THEN 1.0 WHEN bright < 6.0 THEN 0.6 ELSE 0.5 END AS margin FROM weighed),
won AS (SELECT *, CASE WHEN kind <> 'pair' THEN NULL WHEN nb > 1 OR (sn IS NOT NULL AND sn <> 5) THEN 'gaia' WHEN hs < gs*margin THEN 'hip' ELSE 'gaia' END AS w,
  CASE WHEN kind <> 'pair' THEN NULL WHEN nb > 1 THEN 'neighbour_veto' WHEN sn IS NOT NULL AND sn <> 5 THEN 'hip_multiplicity' WHEN hs < gs*margin THEN NULL WHEN gs <= hs THEN NULL ELSE 'gaia_margin' END AS reason FROM judged),
flushed AS (SELECT h.source_id AS hid, x.gaia_source_id AS gid, coalesce(a.override_id, b.override_id) AS oid FROM hip h LEFT JOIN xmatch x ON x.hip_source_id = h.source_id
  LEFT JOIN targets a ON a.source = 'gaia' AND a.source_id = CAST(x.gaia_source_id AS VARCHAR) LEFT JOIN targets b ON b.source = 'hip' AND b.source_id = CAST(h.source_id AS VARCHAR)
  WHERE h.source_id NOT IN (SELECT hid FROM won WHERE hid IS NOT NULL AND kind <> 'alone')),
late AS (SELECT f.*, coalesce(o.action, 'alone') AS kind FROM flushed f LEFT JOIN targets o ON o.override_id = f.oid WHERE f.oid IS NULL OR f.oid NOT IN (SELECT oid FROM won WHERE oid IS NOT NULL)),
used AS (SELECT oid FROM won WHERE oid IS NOT NULL UNION SELECT oid FROM late WHERE oid IS NOT NULL),
carried AS (SELECT CASE kind WHEN 'replace' THEN o.source WHEN 'pair' THEN 'hip' ELSE 'gaia' END AS source, CASE kind WHEN 'replace' THEN o.source_id WHEN 'pair' THEN CAST(hid AS VARCHAR) ELSE CAST(gid AS VARCHAR) END AS source_id,
  gid AS gaia_source_id, g.parallax AS parallax_mas, g.bp_rp AS bp_rp, {_BODY} FROM won l JOIN gaia g ON g.source_id = l.gid LEFT JOIN hip h ON h.source_id = l.hrow LEFT JOIN targets o ON o.override_id = l.oid WHERE kind <> 'drop'),
dense AS (SELECT source, source_id, {", ".join(_PAYLOAD)} FROM carried
  UNION ALL SELECT 'hip', CAST(h.source_id AS VARCHAR), {_cols("h")} FROM late l JOIN hip h ON h.source_id = l.hid WHERE kind = 'alone'
  UNION ALL SELECT o.source, o.source_id, {_cols("o")} FROM late l JOIN targets o ON o.override_id = l.oid WHERE kind = 'replace'
  UNION ALL SELECT source, source_id, {", ".join(_PAYLOAD)} FROM overrides WHERE action = 'add'),
decisions AS (
  SELECT 'override' AS decision_type, CAST(gid AS VARCHAR) AS gaia_source_id, CAST(hid AS VARCHAR) AS hip_source_id, CASE WHEN kind = 'replace' THEN 'manual' END AS winner_catalog, CASE WHEN kind = 'replace' THEN o.source_id END AS winner_source_id,
    CASE WHEN hid IS NOT NULL THEN 'gaia_hip_crossmatch' END AS mapping_source, gs AS gaia_score, hs AS hip_score, NULL AS tie_break_reason, o.override_id, o.action AS override_action, o.override_reason, o.override_policy_version,
    CASE WHEN hid IS NULL THEN 'partner_missing' END AS note, NULL::INTEGER AS number_of_neighbours, NULL::DOUBLE AS angular_distance_arcsec, NULL::DOUBLE AS gaia_ruwe, NULL::DOUBLE AS gaia_phot_g_mean_mag, NULL::INTEGER AS hip_solution_type, NULL::DOUBLE AS hip_apparent_mag
    FROM won l JOIN targets o ON o.override_id = l.oid
  UNION ALL SELECT 'score', CAST(gid AS VARCHAR), CAST(hid AS VARCHAR), w, CASE WHEN w = 'gaia' THEN CAST(gid AS VARCHAR) ELSE CAST(hid AS VARCHAR) END, 'gaia_hip_crossmatch', gs, hs, reason, NULL, NULL, NULL, NULL, NULL,
    CAST(nb AS INTEGER), CAST(CAST(ang AS FLOAT) AS DOUBLE), g.ruwe, g.phot_g_mean_mag, h.Sn, h.Hpmag FROM won l JOIN gaia g ON g.source_id = l.gid JOIN hip h ON h.source_id = l.hrow WHERE kind = 'pair'
  UNION ALL SELECT 'override', CAST(gid AS VARCHAR), CAST(hid AS VARCHAR), CASE WHEN kind = 'replace' THEN 'manual' END, CASE WHEN kind = 'replace' THEN o.source_id END, CASE WHEN gid IS NOT NULL THEN 'gaia_hip_crossmatch' END,
    NULL, coalesce(h.astrometry_quality, {_INF}), NULL, o.override_id, o.action, o.override_reason, o.override_policy_version, CASE WHEN o.source = 'gaia' AND o.source_id = CAST(gid AS VARCHAR) THEN 'resolved_in_hip_flush' END, NULL, NULL, NULL, NULL, NULL, NULL
    FROM late l JOIN hip h ON h.source_id = l.hid JOIN targets o ON o.override_id = l.oid
  UNION ALL SELECT 'override_add', NULL, NULL, 'manual', source_id, NULL, NULL, NULL, NULL, override_id, action, override_reason, override_policy_version, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM overrides WHERE action = 'add'
  UNION ALL SELECT 'override_no_effect', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, override_id, action, override_reason, override_policy_version, 'target_and_partner_absent', NULL, NULL, NULL, NULL, NULL, NULL FROM targets WHERE override_id NOT IN (SELECT oid FROM used)),"""
_NULLS = {c: f"CAST(NULL AS {'VARCHAR' if t == 'string' else 'INTEGER' if t == 'int' else t.upper()}) AS {c}" for c, t in ISSUES.items()}


def _issue(values: dict[str, str]) -> str:
    return ", ".join(f"{values[c]} AS {c}" if c in values else _NULLS[c] for c in ISSUES)


_PAIR = {
    "issue_type": "'matched_pair_conflict'", "severity": "CASE WHEN low OR (ruwe_hi AND odd) OR ratio >= 2 THEN 'high' ELSE 'medium' END",
    "reasons": "concat_ws(';', 'distance_disagreement', CASE WHEN low THEN 'winner_not_lowest_astrometry_score' END, CASE WHEN ruwe_hi THEN 'gaia_high_ruwe' END, CASE WHEN odd THEN 'hip_non_standard_solution' END, CASE WHEN ratio >= 2 THEN 'severe_distance_disagreement' END)",
    "source": "'hip'", "source_id": "hip_source_id", "gaia_source_id": "gaia_source_id", "hip_source_id": "hip_source_id", "winner_catalog": "winner_catalog", "winner_source_id": "winner_source_id", "tie_break_reason": "tie_break_reason",
    "distance_ratio": "ratio", "distance_frac_diff": "ratio - 1", "mag_abs_delta": "gm - hm", "gaia_r_pc": "gr", "hip_r_pc": "hr", "gaia_mag_abs": "gm", "hip_mag_abs": "hm", "gaia_score": "gaia_score", "hip_score": "hip_score",
    "gaia_ruwe": "gaia_ruwe", "hip_solution_type": "hip_solution_type", "number_of_neighbours": "number_of_neighbours", "angular_distance_arcsec": "angular_distance_arcsec", "overridden": "false",
}
_ROW = {
    "issue_type": "'merged_row_extreme'", "severity": "CASE WHEN mag_abs <= -8 THEN 'high' ELSE 'medium' END",
    "reasons": "concat_ws(';', CASE WHEN mag_abs <= -8 THEN 'extreme_absolute_magnitude' END, CASE WHEN mag_abs <= -3 AND astrometry_quality >= 1 THEN 'low_quality_astrometry_for_luminous_row' END, CASE WHEN mag_abs <= -3 AND r_pc >= 2000 THEN 'remote_luminous_row' END)",
    "source": "source", "source_id": "source_id", "merged_ra_deg": "ra_deg", "merged_dec_deg": "dec_deg", "merged_r_pc": "r_pc", "merged_mag_abs": "mag_abs", "merged_teff": "teff", "astrometry_quality": "astrometry_quality",
    "photometry_quality": "photometry_quality", "overridden": "false",
}
_QUALITY = f"""
scored AS (SELECT d.*, g.r_pc AS gr, h.r_pc AS hr, g.mag_abs AS gm, h.mag_abs AS hm, greatest(g.r_pc, h.r_pc)/least(g.r_pc, h.r_pc) AS ratio,
  (gaia_score < hip_score AND winner_catalog <> 'gaia') OR (hip_score < gaia_score AND winner_catalog <> 'hip') AS low, coalesce(gaia_ruwe > 1.4, false) AS ruwe_hi, coalesce(hip_solution_type <> 5, false) AS odd
  FROM decisions d JOIN gaia g ON CAST(g.source_id AS VARCHAR) = d.gaia_source_id JOIN hip h ON CAST(h.source_id AS VARCHAR) = d.hip_source_id WHERE decision_type = 'score'),
keyed AS (SELECT DISTINCT source, source_id FROM overrides),
found AS (SELECT {_issue(_PAIR)} FROM scored s WHERE ratio - 1 > 0.25 AND (low OR (ruwe_hi AND (odd OR ratio >= 2)))
    AND NOT EXISTS (SELECT 1 FROM keyed k WHERE (k.source = 'gaia' AND k.source_id = s.gaia_source_id) OR (k.source = 'hip' AND k.source_id = s.hip_source_id))
  UNION ALL SELECT {_issue(_ROW)} FROM dense r WHERE (mag_abs <= -8 OR (mag_abs <= -3 AND (astrometry_quality >= 1 OR r_pc >= 2000))) AND NOT EXISTS (SELECT 1 FROM keyed k WHERE k.source = r.source AND k.source_id = r.source_id)),
issues AS (SELECT {", ".join("coalesce(l.label, '') AS label" if c == "label" else f"i.{c}" for c in ISSUES)} FROM found i LEFT JOIN labels l ON l.source = i.source AND l.source_id = i.source_id),"""
_N = 8  # pixels along a face
_PIX = f"""
spot AS (SELECT source_id, sin(radians(dec)) AS z, (ra - 360*floor(ra/360))/90 AS t FROM gaia_raw),
turned AS (SELECT *, CAST(floor({_N}*(0.5+t) - {_N}*0.75*z) AS INTEGER) AS jp, CAST(floor({_N}*(0.5+t) + {_N}*0.75*z) AS INTEGER) AS jm, CAST(least(floor(t), 3) AS INTEGER) AS c, {_N}*sqrt(3*(1-abs(z))) AS s FROM spot),
capped AS (SELECT *, CAST(least(floor((t-c)*s), {_N}-1) AS INTEGER) AS cp, CAST(least(floor((1-(t-c))*s), {_N}-1) AS INTEGER) AS cm FROM turned),
faced AS (SELECT source_id, CASE WHEN abs(z) > 2.0/3.0 THEN CASE WHEN z >= 0 THEN c ELSE c+8 END WHEN jp//{_N} = jm//{_N} THEN (jp//{_N})%4 + 4 WHEN jp//{_N} < jm//{_N} THEN (jp//{_N})%4 ELSE (jm//{_N})%4 + 8 END AS face,
  CASE WHEN abs(z) > 2.0/3.0 THEN CASE WHEN z >= 0 THEN {_N}-1-cm ELSE cp END ELSE jm%{_N} END AS ix, CASE WHEN abs(z) > 2.0/3.0 THEN CASE WHEN z >= 0 THEN {_N}-1-cp ELSE cm END ELSE {_N}-1-jp%{_N} END AS iy FROM capped),
numbered AS (SELECT source_id, CAST(face*64 + (ix&1) + 2*(iy&1) + 4*((ix>>1)&1) + 8*((iy>>1)&1) + 16*((ix>>2)&1) + 32*((iy>>2)&1) AS INTEGER) AS p FROM faced),"""


#: The same pixels, of rows that have their place in ra_deg and dec_deg.
_PLACED = _PIX.replace("SELECT source_id, sin(radians(dec)) AS z, (ra - 360*floor(ra/360))/90 AS t FROM gaia_raw", "SELECT tab, source, sin(radians(dec_deg)) AS z, (ra_deg - 360*floor(ra_deg/360))/90 AS t FROM rows_").replace("SELECT source_id, CASE", "SELECT tab, source, CASE").replace("SELECT source_id, CAST(face", "SELECT tab, source, CAST(face")


def _nth(table: str, columns: str, keys: str, order: str) -> str:
    return f"(SELECT {columns} FROM {table} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1)"


#: The identifiers again, over the first row of each key, or the last of a star's links, with the override rows in place of their stars.
_IDENTIFIERS_ORDERED = (
    REPEATED
    + f""",
hd_one AS {_nth("hd_rows", "hip, hd", "hip", "seq")}, star_one AS {_nth("star_rows", "hip, hd, bayer, fl, cst", "hip", "seq")}, link_one AS {_nth("link_rows", "gaia_source_id, hip_source_id", "hip_source_id", "seq DESC")},"""
    + _IDENTIFIERS[: _IDENTIFIERS.index("labels AS")].replace("FROM iv27a", "FROM star_one").replace("JOIN hip_hd", "JOIN hd_one").replace("JOIN xmatch", "JOIN link_one")
    .replace("AS proper_name FROM names)", "AS proper_name, seq FROM name_rows), proper_one AS (SELECT hd, proper_name FROM proper WHERE proper_name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY hd ORDER BY seq) = 1)")
    .replace("JOIN proper p", "JOIN proper_one p")
    + """
all_rows AS (SELECT *, 0 AS seq FROM identifiers i WHERE NOT EXISTS (SELECT 1 FROM own_rows o WHERE o.source = i.source AND o.source_id = i.source_id)
  UNION ALL SELECT source, source_id, NULL, NULL, NULL, NULL, NULL, NULL, proper_name, seq FROM own_rows)"""
)
_MERGE_ORDERED = (
    REPEATED.lstrip(",") + f""",
hip_one AS {_nth("hip_rows", "hip, sn, rarad, derad, plx, e_plx, pmra, pmde, hpmag, bv", "hip", "seq DESC")}, xm_one AS {_nth("xm_rows", "gaia_source_id, hip_source_id, number_of_neighbours, angular_distance", "gaia_source_id, hip_source_id", "seq DESC")},"""
    + _GAIA + _HIP.replace("FROM hip_raw", "FROM hip_one") + _OVERRIDES + _MERGE.replace("JOIN xmatch", "JOIN xm_one")
)


def _query(parts: str, select: str) -> str:
    return f"{ADAPTER},{parts.rstrip().rstrip(',')}\n{select}"


def _select(columns, doubles, table: str) -> str:
    return f"SELECT {', '.join(_R(c) if c in doubles else c for c in columns)} FROM {table}"


def _rgb(c: str) -> str:
    k = "(least(greatest(teff, 1000), 40000)/100)"
    clip = lambda e: f"least(greatest({e}, 0), 255)"
    return {
        "r": f"CASE WHEN {k} <= 66 THEN 255.0 ELSE {clip(f'329.698727446*pow(greatest({k}-60, 1e-9), -0.1332047592)')} END",
        "g": f"CASE WHEN {k} <= 66 THEN {clip(f'99.4708025861*ln({k}) - 161.1195681661')} ELSE {clip(f'288.1221695283*pow(greatest({k}-60, 1e-9), -0.0755148492)')} END",
        "b": f"CASE WHEN {k} >= 66 THEN 255.0 WHEN {k} <= 19 THEN 0.0 ELSE {clip(f'138.5177312231*ln(greatest({k}-10, 1e-9)) - 305.0447927307')} END",
    }[c]


def oracle_sql() -> dict[str, str]:
    gaia_cols = [*DENSE, "ruwe", "phot_g_mean_mag"]
    gaia = _select(gaia_cols, [*_DOUBLES, "ruwe", "phot_g_mean_mag"], "gaia")
    hip = _select([*DENSE, "Sn", "Hpmag"], [*_DOUBLES, "Hpmag"], "hip")
    over = ["override_id", "action", "override_reason", "override_policy_version"]
    all_merge = _GAIA + _HIP + _OVERRIDES + _MERGE
    decision_doubles = [c for c, t in DECISIONS.items() if t == "double"]
    counted = """SELECT (SELECT count(*) FROM gaia) AS gaia_rows_total, (SELECT count(*) FROM won WHERE kind = 'alone') AS unmatched_gaia, (SELECT count(*) FROM won WHERE kind = 'pair') AS matched_pairs_scored,
  (SELECT count(*) FROM won WHERE w = 'gaia') AS matched_winner_gaia, (SELECT count(*) FROM won WHERE w = 'hip') AS matched_winner_hip, (SELECT count(*) FROM late WHERE kind = 'alone') AS unmatched_hip,
  count(*) FILTER (decision_type = 'override_add') AS override_add_applied, count(*) FILTER (decision_type = 'override' AND override_action = 'replace') AS override_replace_applied,
  count(*) FILTER (decision_type = 'override' AND override_action = 'drop') AS override_drop_applied, count(*) FILTER (decision_type = 'override_no_effect') AS override_no_effect, count(*) AS decisions_rows,
  (SELECT count(*) FROM dense) AS rows_emitted_total FROM decisions"""
    rgb = ", ".join(f"{_rgb(c)} AS {c}" for c in "rgb")
    return {
        "gaia_stage": _query(_GAIA, gaia),
        "gaia_stage_limited": _query(_GAIA, gaia + " WHERE phot_g_mean_mag <= 8.0"),
        "gaia_carry": _query(_GAIA, "SELECT source_id, round(parallax, 6) + 0.0 AS gaia_parallax_mas, CAST(round_even(ruwe, 0) AS BIGINT) AS gaia_ruwe_rounded, round(bp_rp, 6) + 0.0 AS gaia_bp_rp, CAST(NULL AS VARCHAR) AS gaia_absent, source_id + 4611686018427387905 AS gaia_big, source_id + 4611686018427387905 AS gaia_big_text, CAST(round_even(CAST(source_id % 100 AS DOUBLE) + 0.7, 0) AS BIGINT) AS gaia_tenths, source_id + 4611686018427387905 AS gaia_whole FROM gaia"),
        "gaia_source_rows": f"""{ADAPTER}
SELECT source_id, round(ra, 6) + 0.0 AS ra, round(r_med_geo, 6) + 0.0 AS r_med_geo, CASE WHEN source_id % 7 <> 0 THEN round(mg_gspphot, 6) + 0.0 END AS mg_gspphot,
  CASE WHEN source_id % 7 <> 0 THEN round(ag_gspphot + phot_g_mean_mag, 6) + 0.0 END AS brightness, CASE WHEN source_id % 2 = 0 THEN round(ruwe * 2, 6) + 0.0 END AS mass
FROM gaia_raw WHERE source_id % 3 <> 2 AND source_id % 5 <> 0 AND (r_med_photogeo IS NOT NULL OR r_med_geo IS NOT NULL) AND phot_g_mean_mag <= 15""",
        "quality_summary": _query(all_merge + _IDENTIFIERS + _QUALITY, """SELECT (SELECT count(*) FROM decisions WHERE decision_type = 'score') AS score_decisions,
  (SELECT count(*) FROM decisions WHERE decision_type <> 'score') AS override_decisions, (SELECT count(*) FROM keyed) AS override_targets,
  count(*) FILTER (issue_type = 'matched_pair_conflict') AS matched_pair_issues, count(*) FILTER (issue_type = 'merged_row_extreme') AS merged_row_issues, count(*) AS total_issues,
  (SELECT '{' || string_agg('"' || k || '":' || n, ',' ORDER BY k) || '}' FROM (SELECT issue_type AS k, count(*) AS n FROM issues GROUP BY 1)) AS issue_counts_by_type,
  (SELECT '{' || string_agg('"' || k || '":' || n, ',' ORDER BY k) || '}' FROM (SELECT severity AS k, count(*) AS n FROM issues GROUP BY 1)) AS issue_counts_by_severity FROM issues"""),
        "hip_stage": _query(_HIP, hip),
        "hip_stage_first": _query(_HIP, hip + " ORDER BY source_id LIMIT 25"),
        "crossmatch_map": f"{ADAPTER}\nSELECT gaia_source_id, hip_source_id, 'gaia_hip_crossmatch' AS mapping_source, CAST(number_of_neighbours AS SMALLINT) AS number_of_neighbours, round(CAST(CAST(angular_distance AS FLOAT) AS DOUBLE), 6) + 0.0 AS angular_distance FROM xmatch",
        "override_rows": _query(_OVERRIDES, _select([*DENSE, *over], _DOUBLES, "overrides")),
        "identifiers": _query(_IDENTIFIERS, "SELECT * FROM identifiers"),
        "labels": _query(_IDENTIFIERS, "SELECT * FROM labels WHERE label IS NOT NULL"),
        "merge_dense": _query(all_merge, _select(DENSE, _DOUBLES, "dense")),
        "merge_decisions": _query(all_merge, _select(DECISIONS, decision_doubles, "decisions")),
        "merge_report": _query(all_merge, counted),
        "merge_sidecar": _query(all_merge, _select(["source", "source_id", "gaia_source_id", "parallax_mas", "bp_rp"], ["parallax_mas", "bp_rp"], "carried")),
        "quality_issues": _query(all_merge + _IDENTIFIERS + _QUALITY, _select(ISSUES, [c for c, t in ISSUES.items() if t == "double"], "issues")),
        "quality_counts": _query(all_merge + _IDENTIFIERS + _QUALITY, "SELECT issue_type, severity, count(*) AS n FROM issues GROUP BY 1, 2"),
        "teff_colours": _query(_GAIA, f"SELECT source_id, {', '.join(_R(c) for c in 'rgb')}, printf('#%02x%02x%02x', CAST(trunc(r) AS INTEGER), CAST(trunc(g) AS INTEGER), CAST(trunc(b) AS INTEGER)) AS colour FROM (SELECT source_id, {rgb} FROM gaia)"),
        "flag_counts": _query(_GAIA, "SELECT quality_flags & 15 AS dist_src, (quality_flags >> 4) & 7 AS teff_src, (quality_flags >> 10) & 3 AS phot_src, quality_flags & 128 <> 0 AS valid, quality_flags & 256 <> 0 AS review, quality_flags & 512 <> 0 AS plausible, count(*) AS n FROM gaia GROUP BY 1,2,3,4,5,6"),
        "healpix_counts": _query(_PIX, "SELECT p AS healpix_pixel, count(*) AS n, min(source_id) AS first_id FROM numbered GROUP BY 1"),
        "pixel_files": _query(
            all_merge + "\nrows_ AS (" + " UNION ALL ".join(f"SELECT '{t}' AS tab, source, round(ra_deg, 6) + 0.0 AS ra_deg, round(dec_deg, 6) + 0.0 AS dec_deg FROM {f}" for t, f in (("dense", "dense"), ("gaia_enrichment", "carried"), ("motion", "carried"))) + ")," + _PLACED,
            "SELECT p AS healpix_pixel, count(*) AS n, CAST(count(DISTINCT source = 'gaia') AS INTEGER) AS writes, tab AS table_name FROM numbered GROUP BY p, tab",
        ),
        "crossmatch_ordered": f"{ADAPTER}{REPEATED}\nSELECT gaia_source_id, hip_source_id, 'gaia_hip_crossmatch' AS mapping_source, CAST(number_of_neighbours AS SMALLINT) AS number_of_neighbours, round(CAST(CAST(angular_distance AS FLOAT) AS DOUBLE), 6) + 0.0 AS angular_distance FROM {_nth('xm_rows', '*', 'gaia_source_id, hip_source_id', 'seq')}",
        "identifiers_ordered": f"{ADAPTER}{_IDENTIFIERS_ORDERED}\nSELECT * EXCLUDE (seq) FROM all_rows",
        "labels_ordered": f"{ADAPTER}{_IDENTIFIERS_ORDERED}\nSELECT source, source_id, label FROM (SELECT source, source_id, seq, coalesce(proper_name, CASE WHEN bayer IS NOT NULL THEN concat_ws(' ', bayer, constellation) END, 'HD ' || hd, 'HIP ' || hip_id) AS label FROM all_rows) WHERE label IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source, source_id ORDER BY seq) = 1",
        "merge_dense_ordered": _query(_MERGE_ORDERED, _select(DENSE, _DOUBLES, "dense")),
        "tile_counts": f"{ADAPTER}\nSELECT CAST(source_id >> 9 AS INTEGER) AS hp3, count(*) AS n FROM gaia_raw GROUP BY 1",
    }
