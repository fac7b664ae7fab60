"""Listing analytics on PySpark: plain ``DataFrame -> DataFrame`` operators.

``strata.functions``  Column -> Column scalars (parsing, JSON, geo)
``strata.operators``  DataFrame -> DataFrame operators, usable with ``df.transform``
``strata.sources``    readers, writers, snapshots, layout
``strata.plans``      end-to-end flows and size checks
``strata.streaming``  Structured Streaming ingest and upsert
"""
