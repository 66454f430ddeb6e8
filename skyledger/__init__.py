"""Airline bookings to a history-keeping star schema, as Spark jobs."""
