"""Test inputs and oracle SQL; not part of the library."""
