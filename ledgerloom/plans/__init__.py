"""The whole batch job and the reports that run on its output."""
