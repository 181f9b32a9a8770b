"""quayside — keyed enrichment, reshaping, incremental landing and change-feed
refresh, written as ordinary PySpark DataFrame / Structured Streaming jobs.

Every public function takes and returns DataFrames (``df.transform(fn)``
chains), so Catalyst sees one logical plan per job and can push filters,
prune columns and reuse exchanges across the chain.
"""

from quayside.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
