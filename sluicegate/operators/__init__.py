"""Operators over DataFrames: inference, casting, quarantine, profiling, validation, sinks."""
