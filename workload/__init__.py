"""The library's operators run over the driver tables, each beside its SQL."""

from workload import columns, keys, storage, tables  # noqa: F401
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
