from silverline.streaming.consolidate import consolidate_stream

__all__ = ["consolidate_stream"]
