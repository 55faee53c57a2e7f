"""Report standardisation and data quality as Spark DataFrame plans."""

from labweave.session import checkpoint, configure, shared_dir

__all__ = ["checkpoint", "configure", "shared_dir"]
