"""clickflow: click-log and ad-traffic analytics as Spark DataFrame operators.

Operators take DataFrames and return DataFrames; none of them triggers a job.
Only sinks (``clickflow.sinks``), the streaming driver
(``clickflow.streaming``) and callers' actions run anything.
"""

from clickflow.session import build_session, ensure_session_defaults, scratch_dir

__all__ = ["build_session", "ensure_session_defaults", "scratch_dir"]
