"""tabsmith: ERP master-data migration tabs as Spark DataFrame jobs.

Layers:
  functions/  Column -> Column cleansers and the fixed template values
  operators/  DataFrame(s) -> DataFrame relational building blocks
  sources/    table loading, CSV files, written stages, test-table views
  plans/      the import tabs and the registered queries
  streaming/  the address job over a file stream
"""

__version__ = "0.1.0"
