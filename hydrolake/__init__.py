"""hydrolake: water-reservoir observations as Spark DataFrames.

Bronze payloads (JSON, page text, table cells, positioned words) become typed
long-form series, are merged into an archive and checked, all as DataFrame
expressions, joins, windows and aggregations.
"""

from hydrolake.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
