"""Training-data pipeline operators (quality, dedup, decontamination, mixing, PII, licences, URLs).

Nothing else in the library imports this package; ``__spark_entry__`` registers
its queries when the package is present.
"""

import os


def reach_workers() -> None:
    """Let Python workers import this package from where the driver did.

    Workers do not share the driver's ``sys.path``. Where the package's folder is
    on every machine (a local master, a shared install), its path is enough; a
    cluster without it gets the package by ``--py-files``.
    """
    from pyspark import SparkContext

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    context = SparkContext._active_spark_context
    for env in (os.environ, *([context.environment] if context is not None else [])):
        paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in paths:
            env["PYTHONPATH"] = os.pathsep.join([root, *paths])


reach_workers()
