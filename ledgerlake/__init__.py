"""ledgerlake: filings analytics expressed as Spark DataFrame / SQL jobs.

Layers:
  functions/  Column -> Column helpers and the fixed tag lists
  sources/    raw tables: archive landing, seeds, driver-table adapter
  operators/  staging, FX, metric extraction, conversion, marts, KPIs, text signals
  plans/      composition of operators into the model graph, user views
  streaming/  incremental landing with Structured Streaming
"""

__version__ = "0.1.0"
