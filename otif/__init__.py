"""otif — on-time / in-full delivery analytics on Apache Spark.

Every public function maps DataFrames (plus plain parameters) to a lazy
DataFrame; only ``otif.plans.pipeline`` writes data.
"""

__version__ = "0.1.0"
