"""Screening of mails as they arrive."""
