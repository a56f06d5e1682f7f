"""ringfence: telecom fraud analytics on Spark (DataFrame / SQL / Structured Streaming).

Subpackages: ``sources`` (scans, fixtures, schemas, files), ``functions``
(column helpers), ``operators`` (rules, detection, sequences, windows, joins,
warehouse, quality, scores, aggregates, conditions), ``plans`` (panels and the
registered queries with their SQL oracles) and ``streaming`` (sources, sinks,
jobs).
"""

__version__ = "0.1.0"
