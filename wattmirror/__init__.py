"""PySpark library for mirroring metered time series and reporting on them."""

from wattmirror.session import build_session, prepare

__all__ = ["build_session", "prepare"]
