"""Training-data operators: toxicity, decontamination, quality, dedup, chat, similarity join, mixing, secrets, language, tokens.

Nothing outside this package imports it.  Every module holds one operator with a general interface;
``queries`` holds the thin registered queries.
"""
