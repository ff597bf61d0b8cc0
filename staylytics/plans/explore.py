"""Profile of a feature table: every exploration report, each a lazy DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame

from staylytics.operators import profile
from staylytics.operators.features import target_column


def explore(df: DataFrame, exact: bool = True) -> dict[str, DataFrame]:
    """Reports by name; one whose columns are absent is left out."""
    target, cols = target_column(df), set(df.columns)
    corr = profile.correlations(df, target)
    out = {
        "rows": profile.row_stats(df),
        "types": profile.type_census(df),
        "missing": profile.null_profile(df),
        "correlations": profile.top_correlations(corr),
    }
    if target in cols:
        out["target"] = profile.target_summary(df, target, exact)
    if "room_type" in cols:
        out["room_types"] = profile.category_summary(df, "room_type", target)
    if "property_type" in cols:
        out["property_types"] = profile.top_categories(df, "property_type")
    ranged = ["amenities_count", "host_response_rate_clean", "host_days_active", "distance_to_center"]
    if present := [c for c in ranged if c in cols]:
        out["ranges"] = profile.column_stats(df, present)
    if "host_is_superhost_binary" in cols:
        out["superhosts"] = profile.flag_share(df, ["host_is_superhost_binary"])
    return out
