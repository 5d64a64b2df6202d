from entiprof.streaming.incremental import read_latest, start_refresh

__all__ = ["read_latest", "start_refresh"]
