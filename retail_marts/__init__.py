"""retail_marts: a Spark-native retail BI warehouse.

Layers (each a subpackage):

* ``sources``   - declared source schemas, checked reads, partitioned Parquet sinks
* ``functions`` - reusable ``Column`` expressions (money, keys, dates, safe ratios)
* ``operators`` - ETL, warehouse, dashboard marts, segmentation, satisfaction models
* ``plans``     - composed jobs: the stand-in mapping, the star model used by
                  ``slice``, the query catalogue checked against SQL
* ``streaming`` - intentionally empty (the modelled system has no streams)
"""

from retail_marts.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
