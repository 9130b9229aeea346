"""emporia: commerce analytics as Spark DataFrame jobs.

Sub-packages
------------
sources    readers, declared schemas, writers and the test-table adapter
functions  column expressions shared by the operators (money, calendar, labels)
operators  DataFrame -> DataFrame steps: profiling, cleaning, de-duplication,
           enrichment, ranking, RFM and the business reports
models     MLlib feature pipelines, classifiers, clustering and evaluation tables
plans      session set-up and the end-to-end job that assembles the named tables
oracle     DuckDB SQL text used to check the Spark results independently
streaming  intentionally empty: the analysed workload has no streaming part
"""

__version__ = "0.1.0"
