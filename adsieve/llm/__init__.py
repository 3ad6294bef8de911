"""Training-data operators: dedup, tokenizing, archives, chat, classifiers, packing."""
