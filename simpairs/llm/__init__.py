"""Training-data pipeline operators; each module holds one operator and states its method.

Nothing outside this package imports it. `queries.py` registers one query per operator.
"""
