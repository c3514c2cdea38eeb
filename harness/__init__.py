"""Checks of the library on the TPC-H-like tables: bindings, registered queries, comparison SQL."""
