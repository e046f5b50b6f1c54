"""Operators for preparing training text: ten operators over ``documents`` and their queries.

Nothing else in the library imports this package; ``__spark_entry__.py`` adds its queries when it
is there.  Conventions shared by all operators:

* a word is a maximal run of characters other than space and U+0009..U+000D;
* a null text counts as empty, a null ``doc_id`` sorts after every number, and a null language or
  source is a group of its own;
* input columns that an operator does not name are ignored, whatever they are called;
* tables an operator has to read more than once are written to the folder that the cluster names
  in ``spark.checkpoint.dir``, so a lost executor only repeats the tasks it ran.
"""
