"""Composed jobs: medallion ETL, validation suite, feature table, modelling,
and the registry of named queries over the driver tables."""
