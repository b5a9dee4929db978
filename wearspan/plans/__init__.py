"""End-to-end compositions: feature build, training, scoring."""
