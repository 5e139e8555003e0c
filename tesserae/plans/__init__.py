"""Named queries over the driver's tables."""

from __future__ import annotations

import importlib
from types import ModuleType

#: Modules that register queries.
MODULES = ("retrieval", "rollups", "texts", "checks", "graphs", "runs", "streams", "records", "suggest", "markup", "outline", "rules", "reads", "grids", "stitch", "chains", "subchunks", "versions", "layout", "faults", "batches", "contents", "scores", "folders", "reading", "presence")


def load_catalog() -> ModuleType:
    """The catalogue, with every module's queries registered."""
    for name in MODULES:
        importlib.import_module(f"{__name__}.{name}")
    return importlib.import_module(f"{__name__}.catalog")
