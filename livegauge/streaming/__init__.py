"""The same jobs over streams of landed observations."""
