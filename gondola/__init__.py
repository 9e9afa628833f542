"""gondola: retail nomenclature analytics as Spark DataFrame operators.

Sub-packages: ``functions`` (column expressions), ``operators`` (DataFrame
operators), ``sources`` (scans and sinks), ``plans`` (model variants and the
batch run), ``streaming`` (incremental silver build).
"""

__version__ = "0.1.0"
