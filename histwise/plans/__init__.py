"""Query plans: the feature registry, the fused matrix job, training runs."""
