"""cartlens: shop-session analytics as Spark DataFrame jobs.

Every operator is a function from DataFrame(s) to a DataFrame built from
Spark's own expressions, so Catalyst can prune columns, push filters into the
Parquet scan and plan partial aggregation before each shuffle.
"""

from cartlens.session import build_session, checkpoint_dir, cut_lineage

__all__ = ["build_session", "checkpoint_dir", "cut_lineage"]
