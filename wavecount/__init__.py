"""Web user-behaviour analytics on Spark: event-time counts, rankings and late data."""
