"""wharf: the first layers of a real-time e-commerce warehouse, as Spark DataFrame jobs.

Two jobs share one set of column-expression operators:

* log split: ``log_clean -> fix_is_new -> split_log`` (``wharf.operators.logs``)
* dimension sync: ``cdc_clean -> route -> trim -> apply_changes`` (``wharf.operators.cdc``,
  ``wharf.operators.dim``)

Batch plans live in ``wharf.plans``, Structured Streaming forms in ``wharf.streaming``.
"""

__version__ = "0.1.0"
