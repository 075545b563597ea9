"""Operators for preparing training corpora: filtering, de-duplication, scoring, search, sharding and packing."""
