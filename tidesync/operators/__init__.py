"""DataFrame operators: extraction, schema, loads, profile/log/watermark, retention."""
