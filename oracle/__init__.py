"""Reference answers in SQL, written independently of the library, for the correctness check."""
