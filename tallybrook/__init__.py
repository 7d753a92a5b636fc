"""Spark-native ledger analytics: statement standardisation, balance checks, matching, tagging and portfolios."""
