"""Plans: what to fetch next, from what is stored."""
