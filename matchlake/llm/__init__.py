"""Operators for preparing training text, each a Spark job over whole tables.

Nothing outside this folder imports it.  Shared conventions:

* operators select the columns they need by name, so extra columns are ignored
  (or carried along where rows are returned); working columns start with ``__``;
* null text counts as empty text unless an operator's docstring says otherwise;
* repeated rows are separate rows, also when they share their ``doc_id``;
* scratch tables go under ``spark.checkpoint.dir``.
"""
