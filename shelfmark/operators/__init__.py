"""DataFrame operators: links, fields, cleaning, coercion, projection, integrity, outbox."""
