"""Data-quality rules: checks, expectation suites, contracts, monitors and the report."""
