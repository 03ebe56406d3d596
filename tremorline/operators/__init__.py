from tremorline.operators.clean import (
    CleanOptions,
    add_insert_date,
    clean,
    clean_counted,
    event_rows,
    flat_events,
    insert_date,
    losses,
    nested_events,
    string_events,
    subsecond_events,
)
from tremorline.operators.days import (
    average_daily_count,
    average_daily_count_by_region,
    count_by_day,
    count_by_day_and_region,
)
from tremorline.operators.flatten import (
    explode_features,
    feature_rows,
    flat_geometry,
    nested_geometry,
)
from tremorline.operators.regions import (
    area_and_magnitude,
    average_magnitude_by_region,
    count_by_region,
    magnitudes_by_region,
    regions_above,
    strongest_regions,
    top_regions,
)
from tremorline.operators.versions import latest_events

__all__ = [
    "CleanOptions",
    "add_insert_date",
    "area_and_magnitude",
    "average_daily_count",
    "average_daily_count_by_region",
    "average_magnitude_by_region",
    "clean",
    "clean_counted",
    "count_by_day",
    "count_by_day_and_region",
    "count_by_region",
    "event_rows",
    "explode_features",
    "feature_rows",
    "flat_events",
    "flat_geometry",
    "insert_date",
    "latest_events",
    "losses",
    "magnitudes_by_region",
    "nested_events",
    "nested_geometry",
    "regions_above",
    "string_events",
    "strongest_regions",
    "subsecond_events",
    "top_regions",
]
