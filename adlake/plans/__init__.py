"""The job shapes: what one scheduled run does from request to table."""
