"""riskloom: Spark-native tabular risk analytics.

Every operator takes a DataFrame plus column names and returns a DataFrame
(or a fitted ``pyspark.ml`` stage), so the same call runs on a laptop sample
and on a cluster-sized table.  Sub-packages:

* ``sources``   - readers and report sinks
* ``functions`` - Column-expression helpers (bins, flags, null-aware sums)
* ``operators`` - profiling, imputation, features, encoding, splits,
                  balancing, models, tuning, metrics, fairness, EDA tables
* ``plans``     - reusable scalable plan fragments (exact quantiles,
                  bucketed ranks and running sums, banded KNN join)
"""

__version__ = "0.1.0"
