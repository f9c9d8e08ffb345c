"""Column-level functions: shard routing, value clean-up, conversion rules, audit columns."""
