"""DataFrame-to-DataFrame operators: no reads, writes or actions in here."""
