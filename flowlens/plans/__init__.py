"""Query registry, oracle SQL, exports and the jobs composed from operators."""
