"""Exam analytics for machine event logs, as DataFrame-to-DataFrame functions."""
