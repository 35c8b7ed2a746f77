"""Training-data operators: cleaning, de-duplication, filtering and tokenising of text corpora.

Nothing else in the library imports this package. Every operator takes a DataFrame of documents
and the names of its id and text columns, leaves other columns alone and treats each row as a
document of its own, repeated ids included.
"""
