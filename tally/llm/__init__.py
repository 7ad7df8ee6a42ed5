"""Operators for preparing large text corpora.

Nothing else in ``tally`` imports this subpackage; its queries are added to
the driver contract only when it can be imported.  One module per operator:

1  secret_scan    dictionary-primed zstandard novelty
2  license_scan   Dice coefficient over word bigrams, size bounds
3  source_mix     capped water-filling and seeded repetition
4  chat_format    event-sourced conversations, reversible template
5  toxicity       class-conditional Kneser-Ney models
6  topk_search    M-tree best-first exact top-k
7  piece_codec    SentencePiece encoding as a weighted transducer
8  exact_dedup    content-defined chunk recipes
9  jaccard_join   MinHash LSH forest with exact verification
10 url_filter     sorted digest array
11 filter_audit   sparse document-term matrix, filters in every order
12 quality        nearest-neighbour voting over latent-semantic vectors
13 vector_codes   product codes by limb-split exact matrix products
"""
