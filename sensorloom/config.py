"""Constants and column names of the sensor tables."""

from __future__ import annotations

from dataclasses import dataclass

# The results depend on these.
PORTS = 64
PORTS_PER_CABLE = 6
CABLES = 8
POSITIONS = ("outer", "middle", "inner")
VELOCITIES = ("outer_vel", "middle_vel", "inner_vel")
BASE_PREFIX = "Wood_Temperature"
AFTER_PREFIX = "After_Heat_Pulse_Temperature"
OUTLIER_FLAG = "outlier.Hampel"
NO_BASELINE_FLAG = "no_bl_val"
MOVE_ACTIONS = ("M", "R", "MR")
MOVED = "AddOne"
LETTERS = ("b", "c", "d")
STRICT_VPD = 0.05
LOOSE_VPD = 0.075
LOOSE_VPD_TREES = ("ET1", "ET2", "ET5", "TV3")
EXCLUDED_STATION = "S5"
FINAL_START = "2022-09-01 00:00:00"

SERIES = ("Tree", "Cable")
STEP_SECONDS = 15 * 60

# A series is split into pieces of this many seconds for ordered work, so that
# one long or dense series never sits in a single task.
SPAN_SECONDS = 30 * 86400


@dataclass(frozen=True)
class Limits:
    """Readings outside these closed ranges become missing."""

    temp_min: float = 5.0
    temp_max: float = 30.0
    delta_min: float = 0.05
    delta_max: float = 3.0


@dataclass(frozen=True)
class Probe:
    """Physics of the heat-ratio probe: diffusivity, spacing in cm, seconds per hour."""

    diffusivity: float = 0.0019
    distance_cm: float = 0.5
    seconds: int = 3600


@dataclass(frozen=True)
class ZeroRule:
    """Weather under which sap is taken not to move."""

    wetness_below: float = 25.0
    solar: float = 0.0
    vpd_below: float = STRICT_VPD
    vpd_below_loose: float = LOOSE_VPD
    loose_trees: tuple[str, ...] = LOOSE_VPD_TREES
    min_rows: int = 13
    step_seconds: int = STEP_SECONDS
