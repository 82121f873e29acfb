"""DataFrame operators of the warehouse.

* ``staging``  — typed projection, dedup, long->wide, decode/classify
* ``calendar`` — Easter, Dutch holidays, calendar dimension
* ``dims``     — unknown member, type-1 dimensions, SCD2 from snapshots, bridge
* ``facts``    — lookups to the unknown member, temporal lookup, coverage floor
* ``marts``    — ranking, restated series, share comparison, bridge measure
* ``ordered``  — ordered windows that split hot groups over range partitions
* ``quality``  — data-quality checks returning failing rows, suite runner
* ``profile``  — table / column profiling
"""
