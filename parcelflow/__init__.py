"""parcelflow — last-mile fleet delivery analytics on Apache Spark.

Reports, data-quality checks and a star-schema ETL for delivery operations,
written as DataFrame plans so Catalyst and AQE pick the physical strategy.
Every time anchor is an explicit ``as_of`` date, never the wall clock.
"""

__version__ = "0.1.0"
