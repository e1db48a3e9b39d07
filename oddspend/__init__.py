"""Behavioural outlier scoring for payment-style events on PySpark."""
