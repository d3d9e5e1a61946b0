"""Training-data pipeline operators.

Nothing outside this subpackage imports it.  Modules are imported one by one by
their users, so importing the package itself stays free of side effects.
"""
