"""rosterloom: monthly workforce panels as Spark DataFrame jobs.

``functions``  column builders: seeded draws, text, dates, scores, value pools
``operators``  DataFrame operators: ordered ranks, exact samples, lookups, windows
``plans``      whole jobs: organisation, roster, panel, leaders, export, snapshot analytics
``sources``    the panel schema, Parquet scan and sinks
"""
