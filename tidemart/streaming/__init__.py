from tidemart.streaming.merge import stream_merge

__all__ = ["stream_merge"]
