"""creditloom: credit-risk features, profiling and modelling on Spark DataFrames.

Every function takes and returns ``DataFrame`` or ``Column`` objects. Steps
that must look at the data first come as a pair: ``fit_*`` runs one bounded
aggregate and returns a small Python object, the matching ``apply_*`` is lazy.
"""
