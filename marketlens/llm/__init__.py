"""Training-data operators: chat formatting, language ID, fingerprints,
line / exact / near / substring deduplication, BPE, packing and URL filters.

Nothing else in the library imports this subpackage.  Shared conventions:

* operators read only the columns they name (``id_col``, ``text_col`` ...), so
  extra input columns never clash with internal names;
* a null text counts as an empty text; a null id sorts after every other id;
* intermediate tables go to the folder the cluster names in
  ``spark.checkpoint.dir``; nothing is kept on one executor;
* Python runs in Arrow batches cut into slices of about a megabyte.
"""
