"""Market bars and company news as Spark jobs.

Layers: ``sources`` read, ``functions`` are column expressions, ``operators``
are DataFrame -> DataFrame steps, ``plans`` put them together into the stored
models, ``streaming`` runs the same steps on file streams.
"""
