"""Smart-building data on Spark: catalogs, point selection, metadata, time series, staging."""

from plantroom.operators.selection import PointSelector, Selection
from plantroom.session import configure, local_session
from plantroom.workspace import Workspace

__all__ = ["PointSelector", "Selection", "Workspace", "configure", "local_session"]
