"""Training-data operators: one module per operator, each a plain DataFrame-in, DataFrame-out function.

Nothing else in the library imports this subpackage.  ``queries`` holds the registered queries and their SQL.
"""
