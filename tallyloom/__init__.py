"""tallyloom: clean, enrich, aggregate, rank, roll up and compare large fact tables on Spark."""
