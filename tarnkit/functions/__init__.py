from tarnkit.functions.time_parts import as_timestamp, micros, with_time_parts
from tarnkit.functions.zorder import axis_bounds, with_zorder

__all__ = ["as_timestamp", "axis_bounds", "micros", "with_time_parts", "with_zorder"]
