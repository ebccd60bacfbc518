"""Column expressions shared by the jobs. All run inside code generation."""
