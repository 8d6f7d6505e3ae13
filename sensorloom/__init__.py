"""Sensor-series processing on Spark: lazy DataFrame operators from logger text to analysis-ready tiers."""

from sensorloom.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
