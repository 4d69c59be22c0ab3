"""Operators for preparing text corpora for model training (see ``registry.py``).

Nothing outside this folder imports it. Rules that hold for every operator here:

* a NULL text is an empty text, an empty table gives an empty result with the same columns;
* each row is a document of its own, rows with a repeated id included; ids may be NULL
  (a NULL id sorts after every other id). Operators that compare ids (dedup, joins, fingerprints) take
  integers and end the job at a text id that is none; the others carry the id as it is;
* other columns of the input never clash with the operator's own: only the named id and
  text columns are read, what is carried along travels in one struct.
"""
