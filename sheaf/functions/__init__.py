"""Part of the sheaf engine."""
