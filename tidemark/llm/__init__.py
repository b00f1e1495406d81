"""Operators for training corpora and their queries; nothing outside this folder imports it."""
