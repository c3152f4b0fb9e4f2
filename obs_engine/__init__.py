"""Spark-native analytics for periodic sensor observations.

An *observation table* has one row per ``(entity, instant)`` plus measures,
status attributes and a load time. Every operator is written once over such a
table and then instantiated for the two feeds (bike-share stations and road
arcs).
"""

from obs_engine.session import build_session, pin_utc, shared_dir

__all__ = ["build_session", "pin_utc", "shared_dir"]
