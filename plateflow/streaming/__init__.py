"""Incremental maintenance of totals, ratings, audit log and live figures."""
