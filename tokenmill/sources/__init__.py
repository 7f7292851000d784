"""Corpus sources, tokenizer files and the byte alphabet."""
