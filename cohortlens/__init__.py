"""cohortlens: customer-lifecycle analytics as Spark DataFrame operators.

Layers: ``sources`` (scans, sinks, schemas, fixture views) -> ``plans`` (data products M01-M16,
layered build) built from ``operators`` (DataFrame -> DataFrame blocks) and ``functions``
(Column -> Column helpers); ``streaming`` stages raw files arriving as a stream.
"""

from .config import Config

__all__ = ["Config"]
__version__ = "0.1.0"
