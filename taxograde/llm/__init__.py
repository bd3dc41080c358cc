"""Training-data operators: one module per operator, registered in ``queries``.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries when it can be imported.
"""
