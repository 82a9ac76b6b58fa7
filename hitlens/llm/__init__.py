"""Operators of a training-data pipeline, each one ``DataFrame -> DataFrame``.

Nothing outside this subpackage imports it.  ``registry`` holds the registered
queries; every module holds one operator and the helpers of its method.
"""
