"""Gold models (D10-D16) and the analytical questions built on them.

Each model is a function of its upstream DataFrames; ``Warehouse`` wires them
into the dependency graph the reference's ``ref()`` calls describe, so one
call builds one logical plan that Catalyst optimizes as a whole.
"""
