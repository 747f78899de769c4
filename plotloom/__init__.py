"""plotloom: field-trial and laboratory measurement data as Spark DataFrames.

Sub-packages:

* ``sources``   delimited sheets, tables, sinks
* ``functions`` column functions and domain transforms
* ``operators`` lookups, append-if-absent, reshaping, numbering, statistics
* ``growth``    growth models: curves, fits, grid search, intervals, contrasts
* ``plans``     end-to-end load jobs and analysis views
* ``queries``   the queries registered for the driver tables, with their SQL
"""

import sys

from pyspark import cloudpickle

# Ship our small Python helpers inside the task itself, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
