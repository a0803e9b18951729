"""Operators for preparing training data: packing, sharding, personal data, decontamination, secrets, classifiers,
language-model scores, near duplicates and quality rules.  Nothing else in the library imports this package."""
