"""Column expressions: text cleaning, prompts, vector arithmetic."""
