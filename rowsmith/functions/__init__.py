"""Column expressions, name rules and argument checks shared by the operators."""
