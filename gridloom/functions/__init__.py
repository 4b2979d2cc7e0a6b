"""Column expressions: flux algebra, the grid, calendars."""
