"""Continuous update of a store from a stream of landed filings."""
