"""riskframe: credit-risk analytics as composable Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` (or a fit/transform
pair whose fitted state is a small DataFrame). Work stays in Catalyst-planned
DataFrame expressions; Python touches only summary rows.
"""

from pyspark import cloudpickle

from riskframe.session import get_spark, ensure_checkpoint_dir

# Functions that run in tasks travel by value: executors need no source tree.
cloudpickle.register_pickle_by_value(__import__(__name__))

__all__ = ["get_spark", "ensure_checkpoint_dir"]
