"""cloudmarts: Spark-native usage, billing, support and feedback analytics.

Every operator is a ``DataFrame -> DataFrame`` function (``operators``), built
from column expressions (``functions``), fed by readers (``sources``), written
by ``sinks``, run incrementally by ``streaming`` and wired together in ``plans``.
"""

__version__ = "0.1.0"
