"""tripmart: a bronze / silver / gold trip-data pipeline built on Spark DataFrames.

Layers are plain functions from DataFrame to DataFrame:

* ``operators.bronze``  - data-quality flags, pass / reject / undecided split
* ``operators.metrics`` - every bronze metric from one aggregate
* ``operators.silver``  - conformed, zone-enriched, de-duplicated trips
* ``operators.gold``    - weekly KPIs per borough, previews, run summary
* ``operators.inspect`` - overviews, samples and layer comparison
* ``sources`` / ``plans`` / ``streaming`` - readers, writers, jobs, incremental runs
"""

__version__ = "0.1.0"
