"""Column builders: keys, units, text, hazard rules and weather conditions."""
