"""Change feeds in, current-state tables out, and a check that both agree."""
