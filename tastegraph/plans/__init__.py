"""Plan shapes shared by the operators: skew-safe pair joins, copy groups, durable cuts."""
