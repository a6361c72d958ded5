"""Pipelines composed from the operators: the entity registry and the test-table recipes."""
