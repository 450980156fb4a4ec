"""dimstar: a conformed sales star schema built from Spark DataFrames.

Layout: ``sources`` (the CRM tables), ``functions`` (column rules),
``operators`` (conform-union, latest-per-key, skew-safe joins), ``plans``
(dimensions, facts, star, metrics, data quality) and ``queries`` (the
registered query per operator).
"""
