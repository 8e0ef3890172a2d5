"""Column expressions shared by the operators. No action is run here."""
