from paddock.functions.columns import (  # noqa: F401
    classify_position,
    format_lap_time,
    interval_seconds,
    iso_date,
    nan_to_null,
    points_label,
    race_id,
    round_half_away,
    season_week,
    short_event_name,
    surrogate_key,
    text_or_empty,
    to_int,
)
