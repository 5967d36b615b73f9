"""tabrail: tabular regression and stream scoring as Spark jobs.

Every operator takes and returns DataFrames; the heavy work (scans, joins,
sorts, aggregations, forest training, streaming) runs on Spark executors.
"""

from tabrail.config import Settings, get_session, work_dir

__all__ = ["Settings", "get_session", "work_dir"]
