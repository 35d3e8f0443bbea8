from silverline.sinks.partitioned import write_partitioned

__all__ = ["write_partitioned"]
