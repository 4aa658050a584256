"""Plans: role bindings, the bronze -> silver -> gold pipeline and the query catalogue."""
