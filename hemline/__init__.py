"""Retail lakehouse analytics as plain PySpark DataFrame functions.

``functions``  Column -> Column helpers
``operators``  DataFrame -> DataFrame building blocks (quality, joins, numbering)
``sources``    table, CSV and JDBC exchange, staging, the test-table adapter
``plans``      silver, gold, report and lookup jobs built from the above
"""
