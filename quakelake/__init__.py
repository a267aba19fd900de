"""A bronze, silver and gold lake for GeoJSON event feeds, on Spark DataFrames."""

from quakelake.session import build_session, shared_dir, sized_shuffles

__all__ = ["build_session", "shared_dir", "sized_shuffles"]
