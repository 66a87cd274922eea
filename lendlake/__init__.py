"""Loan-default analytics as composable PySpark DataFrame functions."""
