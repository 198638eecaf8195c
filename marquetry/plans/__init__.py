"""Table builders (silver, gold) and the measure and report layer."""
