"""Operators for training data and entity resolution; nothing outside this subpackage imports it."""
