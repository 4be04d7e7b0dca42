"""Operators for training data: cleaning, deduplication, decontamination and packing of documents."""
