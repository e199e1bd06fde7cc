"""Operators for preparing training text at scale: one module per operator,
``queries`` binds them to the driver's tables.  Nothing outside this package
imports it."""
