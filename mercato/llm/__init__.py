"""Operators for preparing training text at corpus scale.

Each module holds one operator with its own general interface; ``queries``
applies them to the test tables and ``oracles`` states the same results in SQL
where SQL can express them. Nothing else in the library imports this package.
"""
