"""Feature families and query plans."""
