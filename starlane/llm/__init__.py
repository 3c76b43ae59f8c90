"""Operators for large-scale training-data pipelines, one module each.

Nothing else in the library imports this subpackage; ``__spark_entry__``
registers its queries when the folder is present.
"""
