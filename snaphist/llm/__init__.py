"""Operators of a training-data pipeline over a table of documents.

Nothing outside this package imports it. Each module holds one operator;
``queries`` registers one query per operator. Rules shared by all of them:

* inputs are projected to the columns an operator names first, so extra
  columns, whatever they are called, never reach it;
* a NULL text is an empty text, a NULL doc_id sorts after every other id;
* a word is a maximal run of bytes other than space and 0x09-0x0D.
"""
