"""Column expressions shared by the loads, analyses and checks."""
