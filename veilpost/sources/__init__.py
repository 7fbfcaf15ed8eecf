"""Readers and writers for mails, knowledge bases, verdicts and reports."""
