"""Compositions: table registry, silver and gold builds, registered queries."""
