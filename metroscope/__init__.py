"""Urban-mobility data lake and event analytics on PySpark."""

from .session import build_session, scratch_folder

__all__ = ["build_session", "scratch_folder"]
