"""tidemark: snapshot, SCD, fact-modelling and session analytics as Spark DataFrame jobs.

Every operator is a plain function ``DataFrame -> DataFrame`` (or a small
family of them).  Nothing here holds a global session; callers pass the
session or the input frames in.
"""

__all__ = ["operators", "sources", "functions", "plans", "streaming", "session"]
