"""Sustainability analytics as lazy PySpark plans.

The library is layered: ``functions`` hold Column expressions, ``operators``
hold DataFrame transformations, ``sources`` read and write tables and files,
``plans`` compose them into the named models, and ``streaming`` holds the
incremental forms.
"""

__version__ = "0.1.0"
