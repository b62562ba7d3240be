"""Plans: the medallion flow, marts, ops views, dimensions and the query registry."""
