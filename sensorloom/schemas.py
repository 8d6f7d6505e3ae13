"""Schemas of the tables that are read from text; no inference anywhere."""

from __future__ import annotations

from pyspark.sql import types as T

_TS = T.TimestampNTZType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_MEASURES = dict(outer_vel=T.DoubleType(), middle_vel=T.DoubleType(), inner_vel=T.DoubleType())

L1 = _struct(Tree=T.StringType(), Cable=T.IntegerType(), Timestamp=_TS, **_MEASURES)
L2 = _struct(Tree=T.StringType(), Cable=T.StringType(), Timestamp=_TS, **_MEASURES)
L3 = L2
ZEROES = _struct(periodBegin=_TS, periodEnd=_TS, Tree=T.StringType())
ACTIONS = _struct(Tree=T.StringType(), Cable=T.IntegerType(), Timestamp=_TS, Action=T.StringType())
IMPORT_LOG = _struct(Tree=T.StringType(), last_import=_TS)
CABLE_LOCATIONS = _struct(Tree=T.StringType(), Cable=T.IntegerType(), Location=T.StringType())
BASELINE_FLAGS = _struct(
    Tree=T.StringType(), Cable=T.StringType(), Timestamp=_TS,
    baseline_inner=T.StringType(), baseline_middle=T.StringType(), baseline_outer=T.StringType(),
)
HAMPEL_FLAGS = _struct(
    Tree=T.StringType(), Cable=T.StringType(), Timestamp=_TS,
    outer_flag=T.StringType(), middle_flag=T.StringType(), inner_flag=T.StringType(),
)
MICROCLIMATE = _struct(
    Tree=T.StringType(), Station=T.StringType(), Timestamp=_TS,
    Solar=T.DoubleType(), VPD=T.DoubleType(), Wetness=T.DoubleType(), RH=T.DoubleType(),
)
DORMANCY = _struct(Tree=T.StringType(), Cable=T.StringType(), Dormant=_TS, Returned=_TS)
STATION_INFO = _struct(Tree=T.StringType(), **{f"Cable{i}": T.StringType() for i in range(1, 9)})
BAD_WINDOWS = _struct(
    Tree=T.StringType(), Start=_TS, End=_TS,
    **{f"Cable{i}_{p}": T.StringType() for i in range(1, 9) for p in ("Outer", "Middle", "Inner")},
)
