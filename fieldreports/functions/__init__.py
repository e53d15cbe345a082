"""Column-level building blocks: dates, ids, calendar windows, pay rules."""
