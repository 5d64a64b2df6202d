"""entiprof: per-entity profile tables as Spark DataFrame operators.

The library is a set of DataFrame / Column functions (no UDFs, no driver-side
row handling) for assembling wide per-entity profiles: left-join chains,
latest-preferred-row selection, conditional counts and spans, first/last
lookups, group maxima, repeat-entity detection, sorted set concatenation,
lookup fallbacks and priority-ordered source classification.
"""

from entiprof.codes import Codes
from entiprof.session import build_session, cluster_settings, ensure_checkpoint_dir

__all__ = ["Codes", "build_session", "cluster_settings", "ensure_checkpoint_dir"]
