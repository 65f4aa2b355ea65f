"""Training-data operators (text corpora, archives, embeddings, conversations).

Nothing else in ``loanlens`` imports this subpackage; ``__spark_entry__``
registers its queries only when it can be imported.
"""
