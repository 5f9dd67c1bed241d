from .geo import grid_cell, haversine_nm, nm_to_m
from .timecols import epoch_s, iso_millis, utc_day

__all__ = ["grid_cell", "haversine_nm", "nm_to_m", "epoch_s", "iso_millis", "utc_day"]
