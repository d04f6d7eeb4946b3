"""Plans: the synthetic-conversation planner, the rubric and the catalogue of registered queries."""
