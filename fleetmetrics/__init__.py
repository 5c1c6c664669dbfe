"""Machine-fleet telemetry on Spark: ingest, windowed metrics and fleet views.

Every operator is a function from DataFrames to a DataFrame; every clock is an
explicit ``as_of`` argument (a naive ``datetime`` in site-local time), never the
wall clock of the cluster.
"""
