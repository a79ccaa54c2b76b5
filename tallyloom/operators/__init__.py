"""DataFrame-to-DataFrame building blocks of the reports."""
