"""Plans: compositions of the operators into named queries.

* ``catalog`` — the query catalogue over the TPC-H-style test tables.
* ``oracle``  — an independent DuckDB SQL formulation of each query.
* ``registry`` — the vehicle-registry / municipality warehouse models.
"""
