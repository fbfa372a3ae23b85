"""Training-data operators: each module is one operator over a corpus of texts.

Nothing outside this subpackage imports it.
"""
