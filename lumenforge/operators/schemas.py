"""Fixed column orders of the stages' outputs."""

from __future__ import annotations

DENSE = {
    "source": "string", "source_id": "string", "x_icrs_pc": "double", "y_icrs_pc": "double", "z_icrs_pc": "double", "ra_deg": "double", "dec_deg": "double", "r_pc": "double",
    "mag_abs": "double", "teff": "double", "quality_flags": "int", "astrometry_quality": "double", "photometry_quality": "double",
}
IDENTIFIERS = {"source": "string", "source_id": "string", "gaia_source_id": "long", "hip_id": "long", "hd": "long", "bayer": "string", "flamsteed": "long", "constellation": "string", "proper_name": "string"}
CROSSMATCH = {"gaia_source_id": "long", "hip_source_id": "long", "mapping_source": "string", "number_of_neighbours": "short", "angular_distance": "float"}
OVERRIDE_EXTRA = {"override_id": "string", "action": "string", "override_reason": "string", "override_policy_version": "string"}
DECISIONS = {
    "decision_type": "string", "gaia_source_id": "string", "hip_source_id": "string", "winner_catalog": "string", "winner_source_id": "string", "mapping_source": "string",
    "gaia_score": "double", "hip_score": "double", "tie_break_reason": "string", "override_id": "string", "override_action": "string", "override_reason": "string",
    "override_policy_version": "string", "note": "string", "number_of_neighbours": "int", "angular_distance_arcsec": "double", "gaia_ruwe": "double",
    "gaia_phot_g_mean_mag": "double", "hip_solution_type": "int", "hip_apparent_mag": "double",
}
ISSUES = {
    "issue_type": "string", "severity": "string", "reasons": "string", "source": "string", "source_id": "string", "label": "string", "gaia_source_id": "string",
    "hip_source_id": "string", "winner_catalog": "string", "winner_source_id": "string", "tie_break_reason": "string", "distance_ratio": "double", "distance_frac_diff": "double",
    "mag_abs_delta": "double", "apparent_mag_delta": "double", "gaia_apparent_mag": "double", "hip_apparent_mag": "double", "gaia_r_pc": "double", "hip_r_pc": "double",
    "gaia_mag_abs": "double", "hip_mag_abs": "double", "gaia_ra_deg": "double", "gaia_dec_deg": "double", "hip_ra_deg": "double", "hip_dec_deg": "double",
    "merged_ra_deg": "double", "merged_dec_deg": "double", "merged_r_pc": "double", "merged_mag_abs": "double", "merged_teff": "double", "gaia_score": "double",
    "hip_score": "double", "astrometry_quality": "double", "photometry_quality": "double", "gaia_ruwe": "double", "hip_solution_type": "int", "number_of_neighbours": "int",
    "angular_distance_arcsec": "double", "overridden": "boolean",
}
