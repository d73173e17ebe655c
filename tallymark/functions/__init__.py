"""Column expressions; none of them needs a Python worker unless its docstring says so."""
