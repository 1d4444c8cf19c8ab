"""Operators for preparing language-model training data. Nothing else imports this subpackage."""
