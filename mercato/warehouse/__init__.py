"""Star schema: dimensions, facts, customer history, idempotent loads."""
