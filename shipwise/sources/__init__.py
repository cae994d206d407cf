"""Table contracts, readers, report sinks and the order-shaped test-table views."""
