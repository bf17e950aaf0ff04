"""Column expressions: pure builders, no DataFrame in sight."""
