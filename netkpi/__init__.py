"""Network KPI, forecasting and churn analytics on DataFrames."""
import sys

from pyspark import cloudpickle

# functions sent to Python workers carry their code along, so executors need no copy of this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
