"""Layer plans: conform (silver), star schema (gold), reports, quality, jobs."""
