"""Operators for large text corpora: packing, sharding, mixing, fingerprints, classifiers, joins, scans, rules.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own interface over DataFrames; ``queries`` applies each to its
whole table under the name ``opN_<name>``.
"""
