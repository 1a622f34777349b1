"""Operators for preparing language-model training data at cluster scale.

Nothing outside this subpackage imports it; ``braidwork.llm.registry`` lists its
queries for ``__spark_entry__``.
"""
