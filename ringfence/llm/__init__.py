"""Training-data operators: scoring, packing, deduplication, filtering and formatting of text.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""

import os

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers on this machine import the package from where the driver did (elsewhere it is installed)."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    return spark
