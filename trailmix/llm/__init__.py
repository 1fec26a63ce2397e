"""Training-data operators: sharding, de-duplication, packing, personal data,
language identification, quality and token encodings.

Nothing else in the library imports this subpackage.
"""
