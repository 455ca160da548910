"""Delivery-marketplace analytics expressed as Spark plans.

``plateflow.model`` declares the tables, ``plateflow.sources`` builds a
:class:`~plateflow.model.Marketplace` from CSV, Parquet or the benchmark star,
``plateflow.operators`` holds the analytics, ``plateflow.plans`` the refresh and
run jobs and ``plateflow.streaming`` the incremental maintenance.
"""

__version__ = "0.1.0"
