"""Rule-based cleaning, enrichment and risk rating of party-policy records on Spark."""
