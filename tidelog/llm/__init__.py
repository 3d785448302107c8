"""Operators for preparing training text: filters, sketches, near copies, mixing, tokens and models.

Each module holds one operator over general column names; ``queries`` applies them
to the tables ``documents`` and ``pages``.  Python runs only inside tasks, batch by
batch; every operator states what it does with nulls, empty texts and repeated rows.
"""
