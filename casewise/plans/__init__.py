"""Entry jobs: each wires sources, operators, gates and sinks together."""
