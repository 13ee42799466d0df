"""Operators for preparing training data: a separate subpackage that nothing else imports."""
