"""Operators for preparing training data: languages, copies, private data, mixing, packing and more."""
