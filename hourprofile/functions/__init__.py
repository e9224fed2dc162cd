from .columns import (  # noqa: F401
    at_hour,
    composite_key,
    current_hour,
    level,
    log_volume,
    point_wkt,
    scaled_current,
    strip_quotes,
    to_number,
    volumes_array,
    without_hour,
)
