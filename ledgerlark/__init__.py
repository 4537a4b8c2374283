"""ledgerlark: catalogue, price-history and training-data operators, declared on Spark."""

from __future__ import annotations

import os


def importable(spark) -> None:
    """Let Python workers on this machine import the package wherever the driver was started.

    On a cluster the package is shipped with --py-files as usual.
    """
    root, env = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join(p for p in [*paths, root] if p)
