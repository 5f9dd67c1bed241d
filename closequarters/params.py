"""Pipeline parameters.

Every threshold of the pipeline is a field of one frozen dataclass, so a caller
can run the same plan over another region, another grid or another speed limit
without touching code: ``Params(radius_nm=30.0)``.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

# --- Fixed values (must equal the published pipeline's constants for equal results) ---
CENTRE_LAT = 55.225
CENTRE_LON = 14.245
RADIUS_NM = 50.0
EARTH_RADIUS_NM = 3440.065
METRES_PER_NM = 1852.0
BBOX_LAT = (54.3, 56.15)
BBOX_LON = (12.7, 15.8)
MIN_VESSEL_MAX_SOG_KN = 1.0
MAX_PLAUSIBLE_SPEED_KN = 50.0
MIN_PINGS_PER_VESSEL = 20
SOG_NOT_AVAILABLE_KN = 102.2
MMSI_RANGE = (200000000, 799999999)
MMSI_DENY_LIST = (123456789, 987654321)
TIME_BUCKET_S = 60
GRID_CELL_M = 150.0
METRES_PER_DEG_LAT = 111000.0
METRES_PER_DEG_LON = 63700.0
ENCOUNTER_DISTANCE_M = 100.0
MIN_MOVING_SOG_KN = 1.0
SILENCE_WINDOW_S = 60
SILENCE_BUFFER_S = 3600
PORT_CELL_M = 500.0
PORT_MIN_VESSELS = 2
OPERATIONAL_SHIP_TYPES = ("Pilot", "Tug", "SAR", "Law enforcement", "Dredging", "Towing", "Towing long/wide")
UNDEFINED_SHIP_TYPE = "Undefined"
TOP_N = 10
TRAJECTORY_HALF_WINDOW_MIN = 10
FORWARD_CELL_OFFSETS = ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))
HEADING_ARROWS = 5
HEADING_LOOKAHEAD = 9
HEADING_MIN_STEP_DEG = 1e-7
ARROW_FRACTION = 0.04
ARROW_MIN_EXTENT_DEG = 1e-4
MMSI_REPEATED = (111111111, 222222222, 333333333, 444444444, 555555555, 666666666, 777777777, 888888888, 999999999)
# --- end of fixed values ---


@dataclass(frozen=True)
class Params:
    centre_lat: float = CENTRE_LAT
    centre_lon: float = CENTRE_LON
    radius_nm: float = RADIUS_NM
    earth_radius_nm: float = EARTH_RADIUS_NM
    # Box of the region; None: the published box for the published circle, else
    # the smallest box that holds the circle (see ``box``).
    bbox_lat: tuple[float, float] | None = None
    bbox_lon: tuple[float, float] | None = None
    min_vessel_max_sog_kn: float = MIN_VESSEL_MAX_SOG_KN
    max_plausible_speed_kn: float = MAX_PLAUSIBLE_SPEED_KN
    min_pings_per_vessel: int = MIN_PINGS_PER_VESSEL
    sog_not_available_kn: float = SOG_NOT_AVAILABLE_KN
    mmsi_range: tuple[int, int] = MMSI_RANGE
    mmsi_deny_list: tuple[int, ...] = MMSI_DENY_LIST
    mmsi_repeated: tuple[int, ...] = MMSI_REPEATED
    time_bucket_s: int = TIME_BUCKET_S
    grid_cell_m: float = GRID_CELL_M
    metres_per_deg_lat: float = METRES_PER_DEG_LAT
    metres_per_deg_lon: float = METRES_PER_DEG_LON
    encounter_distance_m: float = ENCOUNTER_DISTANCE_M
    min_moving_sog_kn: float = MIN_MOVING_SOG_KN
    silence_window_s: int = SILENCE_WINDOW_S
    silence_buffer_s: int = SILENCE_BUFFER_S
    port_cell_m: float = PORT_CELL_M
    port_min_vessels: int = PORT_MIN_VESSELS
    operational_types: tuple[str, ...] = OPERATIONAL_SHIP_TYPES
    top_n: int = TOP_N
    trajectory_half_window_min: int = TRAJECTORY_HALF_WINDOW_MIN
    cell_offsets: tuple[tuple[int, int], ...] = FORWARD_CELL_OFFSETS
    # Skew guard for the per-vessel ordered windows: a track with more timed pings
    # than this is cut at quantiles of its timestamps into chunks of about as many,
    # so one very long, dense or duplicated track never lands in one task.
    # Neighbours across chunk edges are stitched in.  ``track_chunk_parts`` is the
    # finest cut of one track, ``track_chunks_total`` the most cuts of all tracks.
    track_chunk_pings: int = 200_000
    track_chunk_parts: int = 1024
    track_chunks_total: int = 1_000_000
    # A fixed chunk length in seconds in place of the quantiles (None: quantiles).
    track_chunk_s: int | None = None
    # Encounter join: a (minute, cell) bucket estimated to hold more distinct pings
    # than this is dealt over several keys, one for every ``cell_pings`` of them, at
    # most ``cell_keys``; at most ``dense_cells`` buckets are dealt.
    cell_pings: int = 2000
    cell_keys: int = 1024
    dense_cells: int = 1000
    # Collapse exact duplicate pings before the encounter self-join and
    # re-expand after it, so copies cannot blow up a join bucket.
    collapse_copies: bool = True
    # Collapse reports sharing (mmsi, ts, lat, lon) map-side before the jump
    # window (exact; costs one extra shuffle, so off unless copies are heavy).
    collapse_track_copies: bool = False

    @property
    def lat_cell_deg(self) -> float:
        return self.grid_cell_m / self.metres_per_deg_lat

    @property
    def lon_cell_deg(self) -> float:
        return self.grid_cell_m / self.metres_per_deg_lon

    @property
    def port_lat_deg(self) -> float:
        return self.port_cell_m / self.metres_per_deg_lat

    @property
    def port_lon_deg(self) -> float:
        return self.port_cell_m / self.metres_per_deg_lon

    @property
    def encounter_distance_nm(self) -> float:
        return self.encounter_distance_m / METRES_PER_NM

    def circle_box(self, margin_deg: float = 1e-6) -> tuple[tuple[float, float], tuple[float, float]]:
        """Smallest (lat, lon) box that holds the circle; one that would reach a
        pole or cross the antimeridian spans all longitudes."""
        ang = self.radius_nm / self.earth_radius_nm
        d = math.degrees(ang) + margin_deg
        lat = (max(-90.0, self.centre_lat - d), min(90.0, self.centre_lat + d))
        s = math.sin(min(ang, math.pi / 2)) / max(math.cos(math.radians(self.centre_lat)), 1e-12)
        side = math.degrees(math.asin(s)) + margin_deg if s < 1 else 360.0
        lon = (self.centre_lon - side, self.centre_lon + side)
        if lat[0] == -90.0 or lat[1] == 90.0 or lon[0] < -180.0 or lon[1] > 180.0:
            lon = (-180.0, 180.0)
        return lat, lon

    @property
    def box(self) -> tuple[tuple[float, float], tuple[float, float]]:
        """The (lat, lon) ranges of the region.  A box given by the caller must
        hold the circle, so that the box test never clips it."""
        published = (self.centre_lat, self.centre_lon, self.radius_nm) == (CENTRE_LAT, CENTRE_LON, RADIUS_NM)
        if self.bbox_lat is None and self.bbox_lon is None:
            return (BBOX_LAT, BBOX_LON) if published else self.circle_box()
        need = self.circle_box(0.0)
        lat, lon = self.bbox_lat or need[0], self.bbox_lon or need[1]
        if lat[0] > need[0][0] or lat[1] < need[0][1] or lon[0] > need[1][0] or lon[1] < need[1][1]:
            raise ValueError(f"the box {lat} x {lon} does not hold the circle, which needs {need}")
        return lat, lon

    def validate(self) -> "Params":
        """Reject grids whose cells are narrower than the encounter distance.

        A longitude cell of ``grid_cell_m / metres_per_deg_lon`` degrees is only
        ``cos(lat) * 111.32 km/deg * that`` metres wide; above the latitude where
        that drops under the encounter distance, neighbours two cells away could
        be missed.
        """
        lat, _ = self.box
        max_abs_lat = max(abs(lat[0]), abs(lat[1]))
        width_m = self.lon_cell_deg * 111320.0 * math.cos(math.radians(max_abs_lat))
        height_m = self.lat_cell_deg * 111132.0
        if min(width_m, height_m) < self.encounter_distance_m:
            raise ValueError(
                f"grid cell {min(width_m, height_m):.1f} m at |lat| {max_abs_lat} is narrower "
                f"than the encounter distance {self.encounter_distance_m} m"
            )
        return self


DEFAULTS = Params()

# Country-prefix (MID) list used by the fixture pipeline; callers with the
# full ITU list pass it as a DataFrame instead (sources.read_mid_codes).
FIXTURE_MID_CODES = (211, 219, 232, 261, 265)
