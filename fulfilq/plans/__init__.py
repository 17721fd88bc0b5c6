"""Plans: lazy compositions of operators (raw -> curated -> star -> marts) and the batch pipeline."""
