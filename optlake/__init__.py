"""optlake: listed-options market data as Spark DataFrame/SQL operators.

Layout:
  sources/    landed vendor pages, flat files, the partitioned table store
  functions/  column expressions (dates, keys, derived fields)
  operators/  DataFrame -> DataFrame operators (filters, merge, coverage, ...)
  plans/      fixture views over the driver's tables and the registered queries
  streaming/  Structured Streaming twins of the batch operators
"""

from optlake.session import get_session, prepare_session, scratch_path

__all__ = ["get_session", "prepare_session", "scratch_path"]
