"""Credit-portfolio analytics on Spark: cleaning, scoring, marts, measures, validation."""
