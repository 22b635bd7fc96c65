"""Commerce analytics jobs on PySpark DataFrames.

Packages: ``sources`` (files in and out), ``functions`` (column
expressions), ``operators`` (generic table jobs), ``plans`` (cleaning,
quality checks and the analysis queries), ``bindings`` (the same jobs bound
to the driver's test tables).
"""
