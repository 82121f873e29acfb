"""Reading, landing, sampling and writing.

* ``landing`` — raw-layer scans, JSON normalisation, landing writes, code
  lists, manifest, reconciliation, source-side selections
* ``sample``  — k-th key, key ranges, key-set samples, sample report
* ``export``  — run folders, (bucketed) materialisation, export report
"""
