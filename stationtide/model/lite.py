"""Columns a retrieval may return."""

from __future__ import annotations

# Always offered columns.
MANDATORY = (
    "observation_id", "observed_variable", "units", "actual_time", "agency", "observation_value", "city",
    "country", "height_of_station_above_sea_level", "latitude", "longitude", "z_coordinate",
    "data_policy_licence", "platform_type", "primary_station_id", "qc_method", "quality_flag", "report_id",
    "report_timestamp", "report_meaning_of_timestamp", "report_duration", "report_type", "sensor_id",
    "source_id", "station_name", "z_coordinate_type",
)
# Columns returned when a source has them.
OPTIONAL = (
    "source_id", "product_citation", "data_policy_licence", "homogenisation_adjustment",
    "homogenisation_method", "uncertainty_type", "uncertainty_value", "uncertainty_units",
    "number_of_observations", "secondary_id", "sensor_model", "station_type", "platform_type", "report_type",
    "station_automation", "profile_id", "z_coordinate", "spatial_representativeness", "exposure_of_sensor",
    "fg_depar@body", "an_depar@body", "fg_depar@offline", "record_timestamp", "value_significance",
    "observation_height_above_station_surface",
)
# Auxiliary columns.
AUXILIARY = (
    "total_uncertainty", "positive_total_uncertainty", "negative_total_uncertainty", "random_uncertainty",
    "positive_random_uncertainty", "negative_random_uncertainty", "systematic_uncertainty",
    "positive_systematic_uncertainty", "negative_systematic_uncertainty", "quasisystematic_uncertainty",
    "positive_quasisystematic_uncertainty", "negative_quasisystematic_uncertainty", "quality_flag",
    "combined_uncertainty", "processing_level", "desroziers_30_uncertainty", "RISE_bias_estimate",
    "humidity_bias_estimate", "wind_bias_estimate",
)
NUMBERED = tuple(
    f"{name}{n}" for n in range(18) for name in ("uncertainty_value", "uncertainty_type", "uncertainty_units")
)


def lite_columns(disabled=()) -> set[str]:
    return (set(MANDATORY) | set(OPTIONAL) | set(NUMBERED) | set(AUXILIARY)) - set(disabled)


def long_names() -> dict[str, str]:
    """Long name of each numbered uncertainty value column."""
    from stationtide.model.codes import UNCERTAINTY_CODES

    return {
        f"uncertainty_value{code}": name.replace(" ", "_") + "_uncertainty"
        for code, name in UNCERTAINTY_CODES.items()
    }
