"""Training-data operators over the tables documents, pages, benchmark and labels.

Nothing else in the library imports this subpackage.
"""
