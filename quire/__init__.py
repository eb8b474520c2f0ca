"""quire: a research-paper corpus pipeline written as Spark DataFrame jobs.

Papers live in Spark tables. Every stage (search, upsert, section
extraction, prompt building, batch generation, verdict parsing, reports)
is a function from DataFrame to DataFrame or a Column expression, so a
chain of stages is one logical plan for Catalyst and AQE.
"""

__version__ = "0.1.0"

# Functions handed to Python workers (mapInPandas in generation and
# conversion) refer to helpers in this package. Pickling the package by
# value ships those helpers with the task, so executors need no copy of
# the package on their path.
try:  # pragma: no cover - depends on the pyspark build
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # an older cloudpickle: workers then import the package
    pass
