from .upsert import stream_upsert

__all__ = ["stream_upsert"]
