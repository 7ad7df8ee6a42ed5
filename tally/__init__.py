"""tally: business-case analytics expressed as Spark DataFrame plans.

Four case families (loyalty sales, order delivery, subscriptions, bank
accounts) are answered by functions that take DataFrames and return
DataFrames.  Everything runs as Spark joins, aggregates and windows; the
dialect rules the analytics depend on (integer averages, boundary-counting
date differences, US weeks, case-insensitive text tests, blank-to-zero
casts) are spelled out as Column expressions in ``tally.functions``.

Layout:
    sources/    table loading, literal dimensions, bindings of the case
                tables onto the driver's parquet tables
    functions/  Column-level rules (dialect semantics, cleaning parsers)
    operators/  reusable DataFrame operators (windows, ids, lists, joins)
    plans/      the named analytics per case family, the query catalog and
                the independent DuckDB oracle SQL
"""

__all__ = ["session"]
