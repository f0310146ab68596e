"""Operations of a training-data pipeline: filters, dedup, decontamination, tokenizers and models.

Nothing else in the library imports this subpackage.
"""
