"""quarrymill: everyday data operations written as Spark jobs.

``operators``, ``sources`` and ``functions`` hold general, parameterised
operations; ``plans`` holds the few helpers that keep ordered, banded and
recursive work distributed; ``catalog`` binds them to the shared tables.
"""
