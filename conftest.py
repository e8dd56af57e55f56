"""Makes the repository root importable in tests."""
