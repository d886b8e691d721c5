"""Column expressions: typing rules, text helpers and time formats."""
