"""Sources, sinks and the test-table bindings."""
