"""phenocast: seasonal-event forecasting operators on Spark DataFrames.

Every operator is a plain function ``DataFrame -> DataFrame`` that takes
column names as arguments, so the same code runs on a laptop fixture and on a
cluster-sized table.  Sub-packages:

* ``sources``   - schema-declared readers, multi-file scans, writers, model I/O
* ``functions`` - column expressions (dates, rounding, hashing, exact quantiles)
* ``operators`` - relational, statistical and MLlib operators
* ``plans``     - stand-in views over the test tables, registered queries and
                  their SQL oracles, end-to-end pipelines
* ``streaming`` - file-stream scoring of newly landed feature rows
"""

__version__ = "0.1.0"
