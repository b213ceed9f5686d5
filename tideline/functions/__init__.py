"""Scalar functions: names, positions, time parts, wire types and encodings."""
